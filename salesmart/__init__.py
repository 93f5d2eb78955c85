"""salesmart — retail sales & returns analytics on Spark.

Layers (all lazy DataFrames; Catalyst + AQE choose the physical plan):

* ``sources``   raw delimited-file reader, column mapping, id/date cleaning,
                dataset profile, sinks, and an adapter from the TPC-H-style
                test tables to the 17-column sales record.
* ``functions`` Column-level helpers (text canonicalisation, calendar parts,
                guarded ratios, money casts).  Built-in expressions only.
* ``operators`` dimension builders, dense surrogate keys, distributed rank,
                row validation + error-rate gate, fact build, constraint report.
* ``plans``     the nine analytics views, the measures and dashboard
                derivations, and the end-to-end warehouse run.
* ``streaming`` micro-batch incremental loading of newly arriving raw files.
"""

from salesmart.config import (
    CanonicalizeConfig,
    EtlConfig,
    SourceConfig,
    ValidationConfig,
)

__all__ = ["CanonicalizeConfig", "EtlConfig", "SourceConfig", "ValidationConfig"]
