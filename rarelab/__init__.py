"""rarelab: rare-class tabular analytics on Spark DataFrames.

Sub-packages:

* ``sources``   - table scans, CSV round trips, dense keys, the study fixtures
* ``functions`` - column expressions: portable hashing, null-safe sums, flags,
                  exact distributed percentile
* ``operators`` - profiling, features, splits, resampling, kNN, logistic
                  regression and metrics, all DataFrame -> DataFrame
* ``plans``     - composed studies (cross-validation, sweeps, cohorts) and the
                  registered query catalogue with its SQL oracle
* ``streaming`` - scoring later cohorts as they arrive, with Structured Streaming
"""

__version__ = "0.1.0"
