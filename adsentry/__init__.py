"""adsentry: invalid-advertising-traffic analytics as Spark DataFrame operators.

Every operator is a plain function ``fn(df, **params) -> DataFrame`` built
from native Spark expressions, so Catalyst, whole-stage codegen and adaptive
execution apply throughout. Sub-packages:

* ``functions``  column-level helpers (IP tests, hour bins, quantiles, scores)
* ``operators``  the analytics operators (subnets, hour profiles, fences,
                 sessions, hardware, profiles, rules, correlation)
* ``sources``    readers, writers and the derived input views
* ``plans``      multi-operator jobs (blacklist chain, report suite, back-fill)
* ``streaming``  the count operators over ``readStream`` sources
"""

__version__ = "0.1.0"
