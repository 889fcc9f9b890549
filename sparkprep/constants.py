"""Values that results depend on, in one place."""

# These must equal the reference's for equal results.
CONSTANT_TERM = "constant_term"          # name of the optional all-ones feature
VIF_THRESHOLD = 10.0                     # default threshold of the VIF screening
VIF_PERFECT_FIT = 1e100                  # VIF reported when r2 is 1
KMEANS_MAX_ITER = 60                     # iteration cap of every K-means run
KMEANS_MIN_FRAC_REASSIGNED = 0.001       # stop when at most this share moves
KMEANS_SWEEP_KS = [8, 12, 16, 20, 24, 28, 32, 36]
ALGO_RANDOM = "kmeans_random"            # algo_type labels of the comparison
ALGO_KMEANSPP = "kmeans++"
RIDGE_ALPHA = 0.5                        # ridge penalty of the per-group models
GROUP_SIZE_PREFIX = "size of x:"         # text of the group size report
ACCUMULATE_PENDING = "Processing..."     # running accumulation before the final row
ACCUMULATE_DONE_PREFIX = "Size: "        # ... and at the final row: "Size: <MB> MB"
ACCUMULATE_DONE_SUFFIX = " MB"
BYTES_PER_VALUE = 8                      # float8 values
