"""Values that must equal the reference program's for identical results.

Fixed values (kept together, in natural order):
- stability threshold per axis: 100 (a centre is stable iff |dx| < 100 and |dy| < 100)
- status line texts: "Has converged", "Has not converged"
- plain-mode sentinel x coordinate: -1 (points with x = -1 are left out of the mean)
- initial best distance of the nearest-centre scan: 2147483647 (a point not strictly
  closer than this to any centre has no centre and fails the job)
- centre text form "x,y"; point text form "(x,y)"; assignment line "cx,cy<TAB>x,y "
"""

STABILITY_THRESHOLD = 100
STATUS_CONVERGED = "Has converged"
STATUS_NOT_CONVERGED = "Has not converged"
PLAIN_SENTINEL_X = -1
INITIAL_BEST_DISTANCE = 2147483647

# Up to this many distinct centres the nearest-centre search is an unrolled
# ``least`` over literal distances (whole-stage codegen); above it an Arrow-batched
# pandas UDF does the arg-min with numpy.
UNROLL_LIMIT = 32

# Up to this many rows a DataFrame of centres is collected and bound into the plan;
# a longer one stays a table (tiled search, loop state in written tables).
IN_PLAN_CENTERS = 4096

MODES = ("plain", "combined")
