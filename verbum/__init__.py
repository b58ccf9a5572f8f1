"""verbum: Spark-native document classification over line-per-document corpora.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL / DataFrame expressions; the only Python that runs on executors is
the per-partition partial-sum kernel of the SVM trainer.
"""

from verbum.params import Params, FIXTURE_PARAMS

__all__ = ["Params", "FIXTURE_PARAMS"]
