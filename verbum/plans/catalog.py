"""Registered queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads ``documents`` through the corpus-line adapter (FIXTURES.md
section 4).  The training side is ``doc_id % 5 <> 0``, the held-out test side
``doc_id % 5 = 0``; queries of training operators read the training side alone,
those of vectors and labels return both, with the column ``side``.  Only the
queries on scanning, the line filter and the parsers of a line read lines of which some lack
``url=``; all others get every text.  Parameters are ``FIXTURE_PARAMS`` (K = 1000,
m = 500, SVM rate 0.05 and 5 iterations) but for ``lr_train``, ``lr_certificate``, ``lr_predict``,
``lr_predict_documents``, ``task_lr_full``, ``task_reduced_both``, ``model_comparison`` and the
queries named ``..._defaults``, which run ``Params()``, the reference's settings, on a trained
model's coefficient report.  Queries that fit a regression leave its weights for their SQL
(``published``).  Floating outputs are rounded to 9
decimals so that they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbum.operators import evaluate as ev
from verbum.operators import linear as lin
from verbum.operators import logreg as lg
from verbum.operators import parse as ps
from verbum.operators import select as sl
from verbum.operators import vectors as vx
from verbum.operators import vocab as vc
from verbum.operators.logreg import lr_fit, lr_predict, lr_score, lr_train
from verbum.operators.svm import SvmModel, svm_early_stop, svm_predict, svm_train
from verbum.params import FIXTURE_EARLY_STOP_TOL, FIXTURE_PARAMS as P, Params
from verbum.plans import tasks as tk
from verbum.plans.published import publish
from verbum.plans.tasks import round_doubles
from verbum.session import scratch_path, write_and_read
from verbum.sources import coefficients as co
from verbum.sources.report import write_report
from verbum.sources.corpus import ALL, TEST, TRAIN, fixture_corpus, range_source, read_table, scan_corpus

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- shared stages

class _Fx:
    """Per-query stages.  Anything read more than once (dictionary, vectors,
    first-step model) is written once under ``spark.checkpoint.dir`` and read
    back, so each corpus side is tokenised once per query, not once per use."""

    def __init__(self, spark: SparkSession, sf: str, params: Params = P):
        self.spark, self.sf, self.p = spark, sf, params
        self._memo: dict = {}

    def _once(self, key, make):
        if key not in self._memo:
            self._memo[key] = make()
        return self._memo[key]

    def lines(self, side=ALL):
        return fixture_corpus(self.spark, self.sf, side)

    def lines_some_without_url(self):
        return fixture_corpus(self.spark, self.sf, missing_url=True)

    def train_tokens(self):
        return ps.corpus_tokens(self.lines(TRAIN))

    def tokens(self, side):
        return self._once(("tokens", side), lambda: write_and_read(ps.corpus_tokens(self.lines(side)), f"tokens-{side}"))

    def dictionary(self):
        return self._once("dict", lambda: write_and_read(
            vc.build_dictionary(vc.word_counts(self.tokens(TRAIN)), self.p.k), "dictionary"))

    def vectors(self, side):
        return self._once(("vec", side), lambda: write_and_read(
            vx.doc_vectors(self.tokens(side), self.dictionary(), self.p.k), f"vectors-{side}"))

    def vectors_of(self, side, dictionary, k):
        """Presence vectors of a side against another dictionary, from the same tokens."""
        return vx.doc_vectors(self.tokens(side), dictionary, k)

    def signed(self, side):
        return vx.with_signed_label(self.vectors(side))

    def joined(self, side):
        return vx.dictionary_join(ps.word_doc_pairs(ps.corpus_tokens(self.lines(side))), self.dictionary(), self.p.k)

    def first_step(self):
        """``(pos, weight, intercept)`` after one SVM step from zero (K rows)."""
        return self._once("step1", lambda: write_and_read(
            lin.svm_first_step(self.signed(TRAIN), self.dictionary(), self.p.k, self.p.svm_rate, self.p.c_divisor), "first-step"))

    def first_weights(self):
        return self.first_step().select("pos", "weight")

    def first_intercept(self):
        return self.first_step().select(F.max("intercept")).scalar()

    def coefficients(self):
        """First-step weights written as a coefficient report, then read back."""
        def make():
            w = self.first_weights()
            top = sl.top_coefficient_words(w.withColumnRenamed("weight", "coef"), self.dictionary(), self.p.k, self.p.top_n)
            report = co.coefficient_report_lines(w, top, None, self.p.top_n)
            path = co.write_coefficient_report(report, scratch_path(self.spark, "coefficients"))
            return co.load_coefficients(self.spark, path)
        return self._once("coefs", make)

    def svm_model(self) -> SvmModel:
        return self._once("svm", lambda: svm_train(self.signed(TRAIN), self.p.k, self.p))

    def svm_pred(self):
        model = self.svm_model()
        return svm_predict(self.signed(TEST), model.weights(self.spark), model.intercept, self.p.k)

    def svm_metrics(self):
        return ev.f1_score(ev.confusion_matrix_signed(self.svm_pred()))

    def reduced(self, weighted=True):
        return self._once(("reduced", weighted), lambda: write_and_read(tk.reduced_dictionary(
            self.dictionary(), self.coefficients() if weighted else None, self.p, weighted), "reduced-dictionary"))

    def svm_full(self):
        def make():
            r = tk.run_svm(self.vectors(TRAIN), self.vectors(TEST), self.p.k, self.p)
            r.dictionary = self.dictionary()
            return r
        return self._once("svm_full", make)

    def lr_model(self, name):
        """The regression on all K words, its weights written; published as ``name`` for the SQL."""
        def make():
            fit = lr_fit(vx.with_binary_label(self.vectors(TRAIN)), self.p.k, self.p)
            publish(self.spark, name, fit.w)
            return fit, write_and_read(fit.weights(self.spark), "lr-weights")
        return self._once("lr", make)

    def trained_coefficients(self):
        """The trained SVM's coefficient report, written by its task and read back."""
        return self._once("trained", lambda: co.load_coefficients(
            self.spark, tk.write_svm_coefficients(self.svm_full(), self.p, scratch_path(self.spark, "coefficients"))))

    def reduced_both(self, name):
        """Rows of both models on the reduced words; the regression's weights are published as ``name``."""
        # FIXTURES.md: the small queries choose by the first step's report, the others by the trained model's
        coefs = self.coefficients() if self.p is P else self.trained_coefficients()
        rows, lr, _ = tk.task_reduced_both(self.lines(TRAIN), coefs, self.lines(TEST), self.p, dictionary=self.dictionary(),
                                           tokens=(self.tokens(TRAIN), self.tokens(TEST)))
        publish(self.spark, name, lr.model.w)
        return rows


def _both(make: Callable[[str], DataFrame]) -> DataFrame:
    """``make`` of the training and of the test side, told apart by ``side``."""
    return make(TRAIN).withColumn("side", F.lit(TRAIN)).unionByName(make(TEST).withColumn("side", F.lit(TEST)))


def _metrics_cols(df):
    return df.select("tp", "fp", "fn", "tn", "precision", "recall", "f1", "f1_pct")


# ---------------------------------------------------------------- queries

def q_scan_corpus(spark, sf):
    fx = _Fx(spark, sf)
    path = scratch_path(spark, "corpus")
    fx.lines_some_without_url().write.text(path)
    return scan_corpus(spark, path)


def q_load_coefficients(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(fx.coefficients())


def q_range_source(spark, sf):
    fx = _Fx(spark, sf)
    vocab = vc.word_counts(fx.train_tokens()).select(F.count(F.lit(1))).scalar()
    return range_source(spark, P.k, vocab)


def q_metrics_report(spark, sf):
    fx = _Fx(spark, sf)
    return ev.metrics_report(fx.svm_metrics())


def q_valid_doc_lines(spark, sf):
    fx = _Fx(spark, sf)
    return ps.valid_doc_lines(fx.lines_some_without_url())


def q_extract_doc_id(spark, sf):
    fx = _Fx(spark, sf)
    return ps.extract_doc_id(fx.lines_some_without_url())


def q_extract_doc_text(spark, sf):
    fx = _Fx(spark, sf)
    return ps.parse_documents(fx.lines_some_without_url())


def q_normalize_text(spark, sf):
    fx = _Fx(spark, sf)
    return ps.normalize_text(ps.parse_documents(fx.lines()))


def q_tokenize(spark, sf):
    fx = _Fx(spark, sf)
    return ps.tokenize(ps.parse_documents(fx.lines()))


def q_explode_words(spark, sf):
    fx = _Fx(spark, sf)
    return ps.explode_words(ps.corpus_tokens(fx.lines()))


def q_word_doc_pairs(spark, sf):
    fx = _Fx(spark, sf)
    return ps.word_doc_pairs(ps.corpus_tokens(fx.lines()))


def q_doc_positions(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: vx.doc_positions(fx.joined(side)))


def q_label_binary(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: vx.with_binary_label(fx.vectors(side)).select("doc_key", "label"))


def q_label_signed(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: fx.signed(side).select("doc_key", "label"))


def q_labeled_points(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: vx.labeled_points(fx.vectors(side), signed=False))


def q_split_list_line(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(co.split_list_line(co.coefficient_list_line(fx.first_weights())))


def q_dictionary_join(spark, sf):
    fx = _Fx(spark, sf)
    return fx.joined(TRAIN)


def q_dictionary_join_test(spark, sf):
    fx = _Fx(spark, sf)
    return fx.joined(TEST)


def q_filter_dictionary(spark, sf):
    fx = _Fx(spark, sf)
    sel = tk.select_positions(fx.coefficients(), fx.dictionary(), P, weighted=True)
    return vc.filter_dictionary(fx.dictionary(), sel, P.m)


def q_word_counts(spark, sf):
    fx = _Fx(spark, sf)
    return vc.word_counts(fx.train_tokens())


def q_doc_position_lists(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: vx.doc_position_lists(ps.corpus_tokens(fx.lines(side)), fx.dictionary(), P.k))


def q_tf_vectors(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: round_doubles(vx.tf_vectors(vx.word_bags(ps.corpus_tokens(fx.lines(side)), fx.dictionary(), P.k))))


def q_binary_vectors(spark, sf):
    fx = _Fx(spark, sf)
    return _both(lambda side: vx.binary_vectors(vx.doc_positions(fx.joined(side))))


def q_training_row_count(spark, sf):
    fx = _Fx(spark, sf)
    return vx.training_row_count(fx.vectors(TRAIN))


def q_coefficient_min_max(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(sl.coefficient_min_max(fx.coefficients()))


def q_hinge_cost(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(lin.hinge_cost(fx.signed(TRAIN), fx.first_weights(),
                                        fx.first_intercept(), P.k, P.c_divisor))


def q_hinge_gradient(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(lin.hinge_gradient(fx.signed(TRAIN), fx.first_weights(),
                                            fx.first_intercept(), P.k, P.c_divisor))


def q_intercept_gradient(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(lin.intercept_gradient(fx.signed(TRAIN), fx.first_weights(),
                                                fx.first_intercept(), P.k))


def q_confusion_matrix(spark, sf):
    return ev.confusion_matrix(q_lr_score(spark, sf))


def q_confusion_matrix_signed(spark, sf):
    fx = _Fx(spark, sf)
    return ev.confusion_matrix_signed(fx.svm_pred())


def q_precision_recall(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(ev.precision_recall(ev.confusion_matrix_signed(fx.svm_pred())))


def q_f1_score(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(_metrics_cols(fx.svm_metrics()))


def q_top_words(spark, sf):
    fx = _Fx(spark, sf)
    return vc.top_words(vc.word_counts(fx.train_tokens()), P.k)


def q_build_dictionary(spark, sf):
    fx = _Fx(spark, sf)
    return fx.dictionary()


def q_reindex_dictionary(spark, sf):
    fx = _Fx(spark, sf)
    return fx.reduced(True)


def q_sample_features_uniform(spark, sf):
    fx = _Fx(spark, sf)
    return sl.sample_features_uniform(fx.dictionary().select("pos"), P.m, P.seed)


def q_minmax_normalize(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(sl.minmax_normalize(fx.coefficients()))


def q_reduced_feature_vectors(spark, sf):
    fx = _Fx(spark, sf)
    rd = fx.reduced(True)
    return _both(lambda side: fx.vectors_of(side, rd, P.m))


# Positions beyond the vocabulary that the coefficient table has.
SHORT_MARGIN = 1000


def q_reduced_dictionary_short_vocabulary(spark, sf):
    """min(m, dictionary size) words are drawn although some coefficients belong to no word.

    K is the counted vocabulary and a margin; the coefficients are the weights
    after one step over the whole vocabulary, and a larger one for each
    position beyond it, which must neither be drawn nor change the norm.
    """
    counts = write_and_read(vc.word_counts(_Fx(spark, sf).train_tokens()), "counts")
    k = counts.count() + SHORT_MARGIN
    d = write_and_read(vc.build_dictionary(counts, k), "dictionary")
    v = write_and_read(tk.vectors_of(_Fx(spark, sf).lines(TRAIN), d, k, any_size=True), "vectors")
    step = write_and_read(lin.svm_first_step(vx.with_signed_label(v), d, k, P.svm_rate, P.c_divisor), "first-step")
    coefs = step.select("pos", F.col("weight").alias("coef"))
    beyond = spark.range(k - SHORT_MARGIN, k).select(F.col("id").cast("int").alias("pos"), F.lit(1.0).alias("coef"))
    return tk.reduced_dictionary(d, coefs.unionByName(beyond), P.with_(k=k, m=12_000))


OPTIMUM_K = 5


def q_lr_train_optimum(spark, sf):
    """At the optimum of the log-loss the fitted probabilities of a position's documents sum to its positive labels.

    ``labels.quality`` over the most frequent words is not separable, so the
    optimum is finite.
    """
    fx = _Fx(spark, sf)
    d = vc.build_dictionary(vc.word_counts(fx.train_tokens()), OPTIMUM_K)
    v = vx.doc_vectors(fx.train_tokens(), write_and_read(d, "dictionary"), OPTIMUM_K)
    known = read_table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), F.col("quality").alias("label"))
    v = write_and_read(v.withColumn("id", F.regexp_replace("doc_key", "^(AU|WK)", "")).join(known, "id").select("doc_key", "label", "idx"), "labelled")
    model = lr_train(v, OPTIMUM_K, P.with_(lr_max_iter=500, lr_tol=1e-12))
    per = lr_predict(model, v, OPTIMUM_K).join(v.select("doc_key", F.explode("idx").alias("pos")), "doc_key")
    return per.groupBy("pos").agg(F.round(F.sum("probability"), 2).alias("fitted"), F.count("*").alias("n"))


def q_top_coefficient_words(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(sl.top_coefficient_words(fx.coefficients(), fx.dictionary(), P.k, P.top_n))


def q_select_top_features(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(sl.select_top_features(fx.coefficients(), P.top_n))


def q_sample_features_weighted(spark, sf):
    fx = _Fx(spark, sf)
    return sl.sample_features_weighted(sl.minmax_normalize(fx.coefficients()), P.m, P.seed)


def q_dot_product(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(lin.dot_product(fx.signed(TEST), fx.first_weights(), P.k))


def q_weight_norm_margin(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(lin.weight_norm_margin(fx.first_weights()))


# The norm of the mean log-loss's gradient that a fit at the reference's settings stays below; that of no weights is above 1.
LR_GRADIENT_BOUND = 1e-3


def q_lr_train(spark, sf):
    """The fit at the reference's settings: its weights, and the gradient at each of them."""
    fx = _Fx(spark, sf, Params())
    _, weights = fx.lr_model("lr_train")
    sums = write_and_read(lg.lr_gradient_sums(vx.with_binary_label(fx.vectors(TRAIN)), weights, fx.p.k), "gradient")
    return round_doubles(lg.lr_gradient(sums, weights))


def q_lr_certificate(spark, sf):
    """Whether that fit is one: loss, gradient norm, and what they must stay below; the loss history falls to it."""
    fx = _Fx(spark, sf, Params())
    fit, weights = fx.lr_model("lr_certificate")
    sums = write_and_read(lg.lr_gradient_sums(vx.with_binary_label(fx.vectors(TRAIN)), weights, fx.p.k), "gradient")
    falls = bool(fit.history) and fit.history[-1] == min(fit.history) and 0 < fit.iterations <= fx.p.lr_max_iter
    c = lg.lr_certificate(sums, LR_GRADIENT_BOUND)
    agrees = F.abs(F.col("loss") - F.lit(fit.history[-1] if fit.history else None).cast("double")) < 1e-6
    return round_doubles(c.select("n", "loss", "grad_norm", "grad_max", "stationary", "learned", (F.lit(falls) & agrees).alias("history_falls_to_loss")))


def q_lr_predict(spark, sf):
    """The fitted model's own probabilities and classes of the test side, at the reference's settings."""
    fx = _Fx(spark, sf, Params())
    fit, _ = fx.lr_model("lr_predict")
    return round_doubles(lr_predict(fit.model, vx.with_binary_label(fx.vectors(TEST)), fx.p.k))


def q_lr_score(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(lr_score(vx.with_binary_label(fx.vectors(TEST)), fx.first_weights(), P.k))


def q_svm_step(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(fx.first_step())


def q_svm_train(spark, sf):
    fx = _Fx(spark, sf)
    model = fx.svm_model()
    return round_doubles(model.weights(spark).withColumn("intercept", F.lit(float(model.intercept))))


def q_svm_training_trace(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(fx.svm_model().trace(spark))


def q_svm_early_stop(spark, sf):
    fx = _Fx(spark, sf)
    return svm_early_stop(fx.svm_model().trace(spark), FIXTURE_EARLY_STOP_TOL)


def q_svm_predict(spark, sf):
    fx = _Fx(spark, sf)
    return round_doubles(fx.svm_pred())


def q_svm_model_comparison(spark, sf):
    fx = _Fx(spark, sf)
    full = ev.model_row(fx.svm_metrics(), "linear_svm_full", P.k)
    rd = fx.reduced(True)
    tr = vx.with_signed_label(fx.vectors_of(TRAIN, rd, P.m))
    te = vx.with_signed_label(fx.vectors_of(TEST, rd, P.m))
    model = svm_train(tr, P.m, P)
    pred = svm_predict(te, model.weights(spark), model.intercept, P.m)
    reduced = ev.model_row(ev.f1_score(ev.confusion_matrix_signed(pred)), "linear_svm_reduced", P.m)
    return full.unionByName(reduced)


def _four_models(fx, name):
    """The models of the three tasks: a scan of the test side for the full dictionary, and one for the reduced."""
    n = fx.dictionary().count()
    lr, _ = fx.lr_model(f"{name}.full")
    full = tk.compare_models(fx.vectors(TEST), lr, fx.svm_full().model, fx.p.k, n, "_full")
    reduced = fx.reduced_both(f"{name}.reduced")
    return ev.model_comparison([full, reduced.withColumn("model", F.concat(F.col("model"), F.lit("_reduced")))])


def q_model_comparison_small(spark, sf):
    return _four_models(_Fx(spark, sf), "model_comparison_small")


def _lr_task(spark, sf, params, name):
    fx = _Fx(spark, sf, params)
    r = tk.task_lr_full(fx.lines(TRAIN), fx.lines(TEST), params)
    publish(spark, name, r.model.w)
    return round_doubles(_metrics_cols(r.metrics))


def q_task_lr_full_small(spark, sf):
    return _lr_task(spark, sf, P, "task_lr_full_small")


def q_task_svm_full(spark, sf):
    fx = _Fx(spark, sf)
    r = tk.task_svm_full(fx.lines(TRAIN), fx.lines(TEST), P)
    return round_doubles(_metrics_cols(r.metrics))


def q_task_reduced_both_small(spark, sf):
    return _Fx(spark, sf).reduced_both("task_reduced_both_small")


def q_task_svm_full_defaults(spark, sf):
    """The SVM task at the reference's settings (K = 20,000, rate 0.001, at most 400 iterations), with the iteration it stops at."""
    fx = _Fx(spark, sf)
    r = tk.task_svm_full(fx.lines(TRAIN), fx.lines(TEST), Params())
    last, cost, _, intercept, _ = r.model.trace_rows[-1]
    return round_doubles(r.metrics.select("tp", "fp", "fn", "tn", "f1_pct", F.lit(last).alias("iterations"), F.lit(r.model.converged).alias("converged"),
                                          F.lit(cost).alias("cost"), F.lit(intercept).alias("intercept")))


def q_task_lr_full(spark, sf):
    """The LR task at the reference's settings."""
    return _lr_task(spark, sf, Params(), "task_lr_full")


def q_task_reduced_both(spark, sf):
    """Both models on m = 10,000 of K = 20,000 words, chosen by the report of the SVM trained on all of them."""
    return _Fx(spark, sf, Params()).reduced_both("task_reduced_both")


def q_model_comparison(spark, sf):
    """The four models of the three tasks at the reference's settings."""
    return _four_models(_Fx(spark, sf, Params()), "model_comparison")


def q_svm_train_defaults(spark, sf):
    fx = _Fx(spark, sf, Params())
    model = fx.svm_model()
    return round_doubles(model.weights(spark).withColumn("intercept", F.lit(float(model.intercept))))


def q_svm_training_trace_defaults(spark, sf):
    """Early costs are short decimals; 1e-13 keeps halves of the ninth place from rounding either way by engine."""
    trace = _Fx(spark, sf, Params()).svm_model().trace(spark)
    return round_doubles(trace.select("iter", *[(F.col(c) + F.lit(1e-13)).alias(c) for c in trace.columns[1:]]))


def q_svm_early_stop_defaults(spark, sf):
    fx = _Fx(spark, sf, Params())
    return svm_early_stop(fx.svm_model().trace(spark), fx.p.svm_tol)


def q_svm_model_comparison_defaults(spark, sf):
    """Both SVMs at the reference's settings; the reduced words are chosen by the full model's report."""
    fx = _Fx(spark, sf, Params())
    full = ev.model_row(fx.svm_full().metrics, "linear_svm_full", fx.dictionary().count())
    rd = write_and_read(tk.reduced_dictionary(fx.dictionary(), fx.trained_coefficients(), fx.p), "reduced-dictionary")
    r = tk.run_svm(fx.vectors_of(TRAIN, rd, fx.p.m), fx.vectors_of(TEST, rd, fx.p.m), fx.p.m, fx.p)
    return full.unionByName(ev.model_row(r.metrics, "linear_svm_reduced", rd.count()))


def _written_report(spark, rows):
    path = scratch_path(spark, "comparison-report")
    write_report(ev.comparison_report(rows), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def q_comparison_report(spark, sf):
    """The report of both SVMs, written by the sink and read back."""
    return _written_report(spark, q_svm_model_comparison(spark, sf))


def q_comparison_report_defaults(spark, sf):
    return _written_report(spark, q_svm_model_comparison_defaults(spark, sf))


def flagship(spark, sf):
    """The metrics of the SVM task at the reference's settings."""
    return round_doubles(_metrics_cols(_Fx(spark, sf, Params()).svm_full().metrics))


def q_lr_predict_documents(spark, sf):
    """Of each document of the test side: its label, and whether the weight table's class is that label."""
    fx = _Fx(spark, sf, Params())
    _, weights = fx.lr_model("lr_predict_documents")
    pred = lr_score(vx.with_binary_label(fx.vectors(TEST)), weights, fx.p.k)
    return pred.select("doc_key", "label", (F.col("prediction") == F.col("label")).alias("right"))


def q_lr_training_confusion(spark, sf):
    """The fit on its own training side, which its words separate: no errors, on all words and on the reduced ones."""
    fx = _Fx(spark, sf)
    out = []
    for name, vectors, k in (("full", fx.vectors(TRAIN), P.k), ("reduced", fx.vectors_of(TRAIN, fx.reduced(True), P.m), P.m)):
        v = write_and_read(vx.with_binary_label(vectors), f"lr-{name}")
        pred = lr_predict(lr_train(v, k, P.with_(lr_max_iter=100)), v, k)
        out.append(ev.confusion_matrix(pred).select(F.lit(name).alias("words"), "*"))
    return out[0].unionByName(out[1])


def q_model_comparison_totals(spark, sf):
    """Of each of the four models: features, documents scored and those of them with the positive label."""
    return q_model_comparison_small(spark, sf).select(
        "model", "n_features", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_docs"), (F.col("tp") + F.col("fn")).alias("n_positive"))


QUERIES: dict[str, Query] = {
    "scan_corpus": q_scan_corpus,
    "load_coefficients": q_load_coefficients,
    "range_source": q_range_source,
    "metrics_report": q_metrics_report,
    "valid_doc_lines": q_valid_doc_lines,
    "extract_doc_id": q_extract_doc_id,
    "extract_doc_text": q_extract_doc_text,
    "normalize_text": q_normalize_text,
    "tokenize": q_tokenize,
    "explode_words": q_explode_words,
    "word_doc_pairs": q_word_doc_pairs,
    "doc_positions": q_doc_positions,
    "label_binary": q_label_binary,
    "label_signed": q_label_signed,
    "labeled_points": q_labeled_points,
    "split_list_line": q_split_list_line,
    "dictionary_join": q_dictionary_join,
    "dictionary_join_test": q_dictionary_join_test,
    "filter_dictionary": q_filter_dictionary,
    "word_counts": q_word_counts,
    "doc_position_lists": q_doc_position_lists,
    "tf_vectors": q_tf_vectors,
    "binary_vectors": q_binary_vectors,
    "training_row_count": q_training_row_count,
    "coefficient_min_max": q_coefficient_min_max,
    "hinge_cost": q_hinge_cost,
    "hinge_gradient": q_hinge_gradient,
    "intercept_gradient": q_intercept_gradient,
    "confusion_matrix": q_confusion_matrix,
    "confusion_matrix_signed": q_confusion_matrix_signed,
    "precision_recall": q_precision_recall,
    "f1_score": q_f1_score,
    "top_words": q_top_words,
    "build_dictionary": q_build_dictionary,
    "reindex_dictionary": q_reindex_dictionary,
    "sample_features_uniform": q_sample_features_uniform,
    "minmax_normalize": q_minmax_normalize,
    "reduced_feature_vectors": q_reduced_feature_vectors,
    "top_coefficient_words": q_top_coefficient_words,
    "select_top_features": q_select_top_features,
    "sample_features_weighted": q_sample_features_weighted,
    "dot_product": q_dot_product,
    "weight_norm_margin": q_weight_norm_margin,
    "lr_train": q_lr_train,
    "lr_certificate": q_lr_certificate,
    "lr_predict": q_lr_predict,
    "lr_score": q_lr_score,
    "svm_step": q_svm_step,
    "svm_train": q_svm_train,
    "svm_training_trace": q_svm_training_trace,
    "svm_early_stop": q_svm_early_stop,
    "svm_predict": q_svm_predict,
    "svm_model_comparison": q_svm_model_comparison,
    "model_comparison": q_model_comparison,
    "model_comparison_small": q_model_comparison_small,
    "task_lr_full": q_task_lr_full,
    "task_lr_full_small": q_task_lr_full_small,
    "task_svm_full": q_task_svm_full,
    "task_reduced_both": q_task_reduced_both,
    "task_reduced_both_small": q_task_reduced_both_small,
    "reduced_dictionary_short_vocabulary": q_reduced_dictionary_short_vocabulary,
    "lr_train_optimum": q_lr_train_optimum,
    "lr_predict_documents": q_lr_predict_documents,
    "lr_training_confusion": q_lr_training_confusion,
    "model_comparison_totals": q_model_comparison_totals,
    "comparison_report": q_comparison_report,
    "task_svm_full_defaults": q_task_svm_full_defaults,
    "svm_train_defaults": q_svm_train_defaults,
    "svm_training_trace_defaults": q_svm_training_trace_defaults,
    "svm_early_stop_defaults": q_svm_early_stop_defaults,
    "svm_model_comparison_defaults": q_svm_model_comparison_defaults,
    "comparison_report_defaults": q_comparison_report_defaults,
}
