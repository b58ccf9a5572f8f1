"""Run parameters.

Defaults are the reference programs' settings; ``FIXTURE_PARAMS`` are the
smaller settings used for the oracle-checked queries on the driver tables
(see FIXTURES.md).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # dictionary size (top-K words) and reduced feature count
    k: int = 20000
    m: int = 10000
    # seed of the deterministic feature samplers
    seed: int = 42
    # hand-written linear SVM (full-batch sub-gradient descent, bold driver)
    svm_rate: float = 0.001
    svm_max_iter: int = 400
    svm_tol: float = 1e-5
    # regularisation constant is n / c_divisor
    c_divisor: float = 1e16
    # logistic regression (L-BFGS) iteration caps (full / reduced dictionary)
    # and convergence tolerance
    lr_max_iter: int = 100
    lr_max_iter_reduced: int = 400
    lr_tol: float = 1e-6
    # number of top words in the coefficient report
    top_n: int = 5
    # decimals kept for floating results compared across engines
    digits: int = 9

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Settings for the oracle-checked queries (FIXTURES.md section 4).
FIXTURE_PARAMS = Params(k=1000, m=500, seed=42, svm_rate=0.05, svm_max_iter=5, svm_tol=1e-5)

# Early-stop threshold used by the oracle-checked early-stop query.
FIXTURE_EARLY_STOP_TOL = 0.1
