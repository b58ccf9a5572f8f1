r"""DuckDB oracle SQL for the registered queries.

Independent re-statement of each query in plain SQL over the pre-registered
views (``documents``, and ``labels`` once).  What a regression leads to is computed
from the weights that its query has published.  Conventions are those of FIXTURES.md
section 4: corpus-line adapter, split ``doc_id % 5``, K = 1000, m = 500,
seed 42, SVM rate 0.05, 5 iterations unrolled as CTEs, floating results
rounded to 9 decimals.
"""

from __future__ import annotations

import re

from verbum.plans.published import weights_file

K = 1000
M = 500
SEED = 42
RATE = 0.05
ITERS = 5
TOL = 1e-5
EARLY_STOP_TOL = 0.1
C_DIVISOR = 1e16
TOP_N = 5
R = 9  # decimals


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


# ------------------------------------------------------------------ front end

def lines_cte(name: str, where: str, missing_url: bool = False) -> str:
    gap = "CASE WHEN doc_id % 50 = 7 THEN '' ELSE " if missing_url else "("
    end = "END" if missing_url else ")"
    return rf"""{name} AS (
  SELECT '<doc id="' || (CASE WHEN lang = 'de' THEN 'AU' ELSE 'WK' END) || CAST(doc_id AS VARCHAR) || '"'
      || {gap}' url="http://' || source || '/' || CAST(doc_id AS VARCHAR) || '"' {end}
      || ' title="t">' || replace(replace(text, chr(13), ' '), chr(10), ' ') || '</doc>' AS value
  FROM documents {where})"""


def docs_cte(name: str, lines: str) -> str:
    return f"""{name} AS (
  SELECT doc_key, body FROM (
    SELECT CASE WHEN instr(value, 'id="') > 0 AND instr(value, '" url=') > 0
                THEN substr(value, instr(value, 'id="') + 4,
                            greatest(instr(value, '" url=') - (instr(value, 'id="') + 4), 0)) END AS doc_key,
           CASE WHEN instr(value, '">') > 0
                THEN substr(value, instr(value, '">') + 2,
                            greatest(length(value) - (instr(value, '">') + 2) + 1 - 6, 0)) END AS body
    FROM {lines} WHERE contains(value, 'id') AND contains(value, 'url=')
  ) WHERE doc_key IS NOT NULL AND body IS NOT NULL)"""


def tokens_cte(name: str, docs: str) -> str:
    return f"""{name} AS (
  SELECT doc_key,
         list_filter(string_split(lower(regexp_replace(body, '[^a-zA-Z]', ' ', 'g')), ' '), lambda t: t <> '') AS words
  FROM {docs})"""


def front(side: str) -> list[str]:
    """lines_/docs_/tokens_ CTEs for side in (all, train, test)."""
    where = {"all": "", "train": "WHERE doc_id % 5 <> 0", "test": "WHERE doc_id % 5 = 0"}[side]
    return [lines_cte(f"lines_{side}", where), docs_cte(f"docs_{side}", f"lines_{side}"),
            tokens_cte(f"tokens_{side}", f"docs_{side}")]


# Lines of which some lack url=, for the queries on the line filter and the parsers.
SOME_WITHOUT_URL = [lines_cte("lines_all", "", missing_url=True), docs_cte("docs_all", "lines_all")]

DICT = [
    *front("train"),
    """counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM tokens_train) GROUP BY word)""",
    f"""dict AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS pos
  FROM (SELECT word, n FROM counts ORDER BY n DESC, word LIMIT {K}))""",
]


def pairs_cte(name: str, side: str, dictionary: str = "dict") -> str:
    return f"""{name} AS (
  SELECT t.doc_key, t.word, d.pos FROM (SELECT doc_key, unnest(words) AS word FROM tokens_{side}) t
  JOIN {dictionary} d ON t.word = d.word)"""


def vectors_cte(name: str, pairs: str) -> str:
    return f"""{name} AS (SELECT doc_key, list_sort(list_distinct(list(pos))) AS idx FROM {pairs} GROUP BY doc_key)"""


def signed_cte(name: str, vectors: str) -> str:
    return f"""{name} AS (SELECT doc_key, CASE WHEN starts_with(doc_key, 'AU') THEN 1 ELSE -1 END AS label, idx
  FROM {vectors})"""


def vpos_cte(name: str, signed: str) -> str:
    return f"""{name} AS (SELECT doc_key, label, unnest(idx) AS pos FROM {signed})"""


TRAIN_VECTORS = DICT + [pairs_cte("pairs_train", "train"), vectors_cte("vec_train", "pairs_train"),
                        signed_cte("sgn_train", "vec_train"), vpos_cte("vpos_train", "sgn_train")]
TEST_VECTORS = front("test") + [pairs_cte("pairs_test", "test"), vectors_cte("vec_test", "pairs_test"),
                                signed_cte("sgn_test", "vec_test"), vpos_cte("vpos_test", "sgn_test")]


# ------------------------------------------------------------------ SVM, unrolled

def svm_ctes(p: str, dictionary: str, vpos: str, signed: str, iters: int, rate: float, tol: float) -> list[str]:
    """CTEs {p}w0..{p}w{iters}, {p}st0..{p}st{iters}, {p}c1.., {p}g1.., {p}gb1.. and {p}trace.

    State row st{t}: b, rate, oldcost, stopped (the loop has exited), plus the
    trace fields of iteration t.  Once stopped, weights and state carry over.
    """
    n = f"(SELECT n FROM {p}nn)"
    c = f"(SELECT c FROM {p}nn)"
    out = [
        f"""{p}nn AS (SELECT {D('count(*)')} AS n, {D('count(*)')} / {D(C_DIVISOR)} AS c FROM {signed})""",
        f"""{p}w0 AS (SELECT pos, {D(0)} AS w FROM {dictionary})""",
        f"""{p}st0 AS (SELECT {D(0)} AS b, {D(rate)} AS rate, CAST('inf' AS DOUBLE) AS oldcost, false AS stopped,
  0 AS iter, {D('NULL')} AS cost, {D('NULL')} AS rate_used, {D('NULL')} AS margin, false AS ran)""",
    ]
    for t in range(1, iters + 1):
        q = t - 1
        out += [
            f"""{p}m{t} AS (SELECT v.doc_key, v.label, sum(w.w) - (SELECT b FROM {p}st{q}) AS margin
  FROM {vpos} v JOIN {p}w{q} w ON v.pos = w.pos GROUP BY v.doc_key, v.label)""",
            f"""{p}c{t} AS (SELECT ({D(1)} / {n}) * coalesce(sum(greatest({D(0)}, {D(1)} - label * margin)), 0)
  + ({D(1)} / {D(2)} * {n} * {c}) * power((SELECT sqrt(sum(w * w)) FROM {p}w{q}), 2) AS cost FROM {p}m{t})""",
            f"""{p}g{t} AS (SELECT v.pos, {D('sum(-m.label)')} AS s FROM {p}m{t} m JOIN {vpos} v ON m.doc_key = v.doc_key
  WHERE m.label * m.margin < 1 GROUP BY v.pos)""",
            f"""{p}gb{t} AS (SELECT {D('coalesce(sum(CASE WHEN label * margin < 1 THEN label ELSE 0 END), 0)')} AS s
  FROM {p}m{t})""",
            f"""{p}w{t} AS (SELECT w.pos, CASE WHEN (SELECT stopped FROM {p}st{q}) THEN w.w
    ELSE w.w - (SELECT rate FROM {p}st{q}) * (({D(1)} / {n}) * coalesce(g.s, {D(0)}) + ({D(2)} / {n} * {c}) * w.w) END AS w
  FROM {p}w{q} w LEFT JOIN {p}g{t} g ON w.pos = g.pos)""",
            f"""{p}st{t} AS (SELECT
    CASE WHEN s.stopped THEN s.b ELSE s.b - s.rate * (({D(1)} / {n}) * gb.s) END AS b,
    CASE WHEN s.stopped THEN s.rate WHEN s.oldcost > c.cost THEN s.rate * {D(1.05)} ELSE s.rate * {D(0.5)} END AS rate,
    CASE WHEN s.stopped THEN s.oldcost ELSE c.cost END AS oldcost,
    s.stopped OR (s.oldcost - c.cost < {D(tol)}) AS stopped,
    {t} AS iter, c.cost AS cost, s.rate AS rate_used,
    (SELECT {D(2)} / nullif(sqrt(sum(w * w)), 0) FROM {p}w{t}) AS margin,
    NOT s.stopped AS ran
  FROM {p}st{q} s, {p}c{t} c, {p}gb{t} gb)""",
        ]
    union = " UNION ALL ".join(f"SELECT * FROM {p}st{t}" for t in range(1, iters + 1))
    out.append(f"""{p}trace AS (SELECT CAST(iter AS INTEGER) AS iter, cost, rate_used AS learning_rate, b AS intercept, margin
  FROM ({union}) WHERE ran)""")
    return out


def both(ctes: list[str], body: str) -> str:
    """``body`` of the training and of the test side; {side} in it is the side's name."""
    return with_(ctes, " UNION ALL ".join(f"SELECT *, '{side}' AS side FROM ({body.format(side=side)})" for side in ("train", "test")))


def with_(ctes: list[str], body: str) -> str:
    seen, uniq = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            uniq.append(c)
    return "WITH " + ",\n".join(uniq) + "\n" + body


BOTH_VECTORS = TRAIN_VECTORS + TEST_VECTORS
SVM5 = TRAIN_VECTORS + svm_ctes("s_", "dict", "vpos_train", "sgn_train", ITERS, RATE, TOL)
STEP1 = TRAIN_VECTORS + svm_ctes("f_", "dict", "vpos_train", "sgn_train", 1, RATE, TOL)

# Coefficients: first-step weights as a '[...]' line, split and cast back.
COEF = STEP1 + [
    """coef_line AS (SELECT '[' || string_agg(CAST(w AS VARCHAR), ', ' ORDER BY pos) || ']' AS value FROM f_w1)""",
    r"""coefs AS (SELECT CAST(pos AS INTEGER) AS pos, CAST(trim(tok) AS DOUBLE) AS coef FROM (
  SELECT unnest(generate_series(0, len(parts) - 1)) AS pos, unnest(parts) AS tok FROM (
    SELECT string_split(regexp_replace(trim(value), '[\[\]]', '', 'g'), ',') AS parts FROM coef_line
    WHERE starts_with(trim(value), '['))))""",
    """mm AS (SELECT max(coef) AS max_coef, min(coef) AS min_coef FROM coefs)""",
    """norm AS (SELECT pos, coef, (coef - (SELECT min_coef FROM mm)) / nullif((SELECT max_coef FROM mm) - (SELECT min_coef FROM mm), 0) AS p
  FROM coefs)""",
]


def u_expr(pos: str) -> str:
    return f"((CAST(('0x' || substr(md5('{SEED}:' || CAST({pos} AS VARCHAR)), 1, 8)) AS BIGINT) + 1) / {D(4294967297)})"


SELECTED_W = COEF + [
    f"""selected AS (SELECT pos FROM norm WHERE p > 0 ORDER BY -ln({u_expr('pos')}) / p, pos LIMIT {M})""",
    """dict_kept AS (SELECT word, pos FROM dict WHERE pos IN (SELECT pos FROM selected))""",
    """rdict AS (SELECT word, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS pos FROM dict_kept)""",
]

REDUCED = SELECTED_W + [
    pairs_cte("rpairs_train", "train", "rdict"), vectors_cte("rvec_train", "rpairs_train"),
    signed_cte("rsgn_train", "rvec_train"), vpos_cte("rvpos_train", "rsgn_train"),
]


def metrics_body(pred: str, negative: int) -> str:
    return f"""SELECT tp, fp, fn, tn, precision, recall, f1, round(100 * f1, 2) AS f1_pct FROM (
  SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM (
    SELECT *, {D('tp')} / nullif({D('tp + fp')}, 0) AS precision, {D('tp')} / nullif({D('tp + fn')}, 0) AS recall FROM (
      SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
             CAST(count_if(label = {negative} AND prediction = 1) AS BIGINT) AS fp,
             CAST(count_if(label = 1 AND prediction = {negative}) AS BIGINT) AS fn,
             CAST(count_if(label = {negative} AND prediction = {negative}) AS BIGINT) AS tn
      FROM {pred})))"""


def svm_pred_cte(name: str, p: str, vpos_test: str, iters: int) -> str:
    return f"""{name} AS (SELECT t.doc_key, t.label, sum(w.w) AS score,
    CASE WHEN sum(w.w) - (SELECT b FROM {p}st{iters}) >= 0 THEN 1 ELSE -1 END AS prediction
  FROM {vpos_test} t JOIN {p}w{iters} w ON t.pos = w.pos GROUP BY t.doc_key, t.label)"""


SVM_PRED = SVM5 + TEST_VECTORS + [svm_pred_cte("svm_pred", "s_", "vpos_test", ITERS),
                                  f"svm_metrics AS ({metrics_body('svm_pred', -1)})"]


def _r(c: str, alias: str | None = None) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0
    return f"round({c}, {R}) + 0.0 AS {alias or c}"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_corpus"] = with_(SOME_WITHOUT_URL, "SELECT value FROM lines_all WHERE value IS NOT NULL")
    q["valid_doc_lines"] = with_(SOME_WITHOUT_URL,
                                 "SELECT value FROM lines_all WHERE contains(value, 'id') AND contains(value, 'url=')")
    q["extract_doc_id"] = with_(SOME_WITHOUT_URL, "SELECT doc_key FROM docs_all")
    q["extract_doc_text"] = with_(SOME_WITHOUT_URL, "SELECT doc_key, body FROM docs_all")
    q["normalize_text"] = with_(front("all"),
                                "SELECT doc_key, lower(regexp_replace(body, '[^a-zA-Z]', ' ', 'g')) AS text FROM docs_all")
    q["tokenize"] = with_(front("all"), "SELECT doc_key, words FROM tokens_all")
    q["explode_words"] = with_(front("all"), "SELECT unnest(words) AS word, 1 AS one FROM tokens_all")
    q["word_doc_pairs"] = with_(front("all"), "SELECT doc_key, unnest(words) AS word FROM tokens_all")
    q["word_counts"] = with_(DICT, "SELECT word, n FROM counts")
    q["top_words"] = with_(DICT, f"SELECT word, n FROM counts ORDER BY n DESC, word LIMIT {K}")
    q["build_dictionary"] = with_(DICT, "SELECT word, pos FROM dict")
    q["range_source"] = with_(DICT, f"""SELECT CAST(range AS BIGINT) AS pos FROM range({K})
  WHERE range < (SELECT count(*) FROM counts)""")
    q["dictionary_join"] = with_(TRAIN_VECTORS, "SELECT doc_key, word, pos FROM pairs_train")
    q["dictionary_join_test"] = with_(DICT + front("test") + [pairs_cte("pairs_test", "test")],
                                      "SELECT doc_key, word, pos FROM pairs_test")
    q["doc_positions"] = both(BOTH_VECTORS, "SELECT doc_key, pos FROM pairs_{side}")
    q["doc_position_lists"] = both(BOTH_VECTORS, """SELECT doc_key, list(pos ORDER BY pos) AS idx, list(n ORDER BY pos) AS cnt
  FROM (SELECT doc_key, pos, count(*) AS n FROM pairs_{side} GROUP BY doc_key, pos) GROUP BY doc_key""")
    q["tf_vectors"] = both(BOTH_VECTORS, f"""SELECT doc_key, pos, {_r('n / sum(n) OVER (PARTITION BY doc_key)', 'tf')}
  FROM (SELECT doc_key, pos, {D('count(*)')} AS n FROM pairs_{{side}} GROUP BY doc_key, pos)""")
    q["binary_vectors"] = both(BOTH_VECTORS, "SELECT doc_key, idx FROM vec_{side}")
    q["training_row_count"] = with_(TRAIN_VECTORS, "SELECT count(*) AS n FROM vec_train")
    q["label_binary"] = both(BOTH_VECTORS,
                              "SELECT doc_key, CASE WHEN starts_with(doc_key, 'AU') THEN 1 ELSE 0 END AS label FROM vec_{side}")
    q["label_signed"] = both(BOTH_VECTORS, "SELECT doc_key, label FROM sgn_{side}")
    q["labeled_points"] = both(BOTH_VECTORS,
                                "SELECT doc_key, CASE WHEN starts_with(doc_key, 'AU') THEN 1 ELSE 0 END AS label, idx FROM vec_{side}")

    # one SVM step from zero, and quantities at that model
    q["svm_step"] = with_(STEP1, f"SELECT pos, {_r('w', 'weight')}, {_r('(SELECT b FROM f_st1)', 'intercept')} FROM f_w1")
    q["split_list_line"] = with_(COEF, f"SELECT pos, {_r('coef')} FROM coefs")
    q["load_coefficients"] = q["split_list_line"]
    q["coefficient_min_max"] = with_(COEF, f"SELECT {_r('max_coef')}, {_r('min_coef')} FROM mm")
    q["minmax_normalize"] = with_(COEF, f"SELECT pos, {_r('coef')}, {_r('p')} FROM norm")
    q["select_top_features"] = with_(COEF, f"SELECT pos, {_r('coef')} FROM coefs ORDER BY coef DESC, pos LIMIT {TOP_N}")
    q["top_coefficient_words"] = with_(COEF, f"""SELECT CAST(row_number() OVER (ORDER BY c.coef DESC, c.pos) - 1 AS INTEGER) AS rank,
    d.word, {_r('c.coef', 'coef')}, c.pos
  FROM (SELECT pos, coef FROM coefs ORDER BY coef DESC, pos LIMIT {TOP_N}) c JOIN dict d ON c.pos = d.pos""")
    q["sample_features_weighted"] = with_(SELECTED_W, "SELECT pos FROM selected")
    q["sample_features_uniform"] = with_(DICT, f"SELECT pos FROM dict ORDER BY {u_expr('pos')}, pos LIMIT {M}")
    q["filter_dictionary"] = with_(SELECTED_W, "SELECT word, pos FROM dict_kept")
    q["reindex_dictionary"] = with_(SELECTED_W, "SELECT word, pos FROM rdict")
    # K beyond the vocabulary: the whole word list, first-step weights of its positions
    q["reduced_dictionary_short_vocabulary"] = with_([
        *DICT[:-1],
        """dict AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS pos FROM counts)""",
        *TRAIN_VECTORS[len(DICT):],
        *svm_ctes("f_", "dict", "vpos_train", "sgn_train", 1, RATE, TOL),
        """norm AS (SELECT pos, (w - (SELECT min(w) FROM f_w1)) / nullif((SELECT max(w) - min(w) FROM f_w1), 0) AS p FROM f_w1)""",
        f"""selected AS (SELECT pos FROM norm ORDER BY CASE WHEN p > 0 THEN -ln({u_expr('pos')}) / p END NULLS LAST, {u_expr('pos')}, pos LIMIT 12000)""",
    ], "SELECT word, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS pos FROM dict WHERE pos IN (SELECT pos FROM selected)")
    q["lr_train_optimum"] = with_([
        *DICT[:-1],
        """dict AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS pos
  FROM (SELECT word, n FROM counts ORDER BY n DESC, word LIMIT 5))""",
        pairs_cte("pairs_train", "train"),
        "held AS (SELECT DISTINCT doc_key, pos FROM pairs_train)",
    ], """SELECT pos, CAST(sum(quality) AS DOUBLE) AS fitted, count(*) AS n
FROM held JOIN labels ON substr(doc_key, 3) = CAST(doc_id AS VARCHAR) GROUP BY pos""")
    reduced_test = front("test") + [pairs_cte("rpairs_test", "test", "rdict"), vectors_cte("rvec_test", "rpairs_test")]
    q["reduced_feature_vectors"] = both(REDUCED + reduced_test, "SELECT doc_key, idx FROM rvec_{side}")

    # cost / gradients at the first-step model = iteration 2 of the unrolled loop
    two = TRAIN_VECTORS + svm_ctes("f_", "dict", "vpos_train", "sgn_train", 2, RATE, TOL)
    q["hinge_cost"] = with_(two, f"SELECT {_r('cost')} FROM f_c2")
    q["hinge_gradient"] = with_(two, f"""SELECT w.pos,
    {_r(f"({D(1)} / (SELECT n FROM f_nn)) * coalesce(g.s, {D(0)}) + ({D(2)} / (SELECT n FROM f_nn) * (SELECT c FROM f_nn)) * w.w", 'grad')}
  FROM f_w1 w LEFT JOIN f_g2 g ON w.pos = g.pos""")
    q["intercept_gradient"] = with_(two, f"SELECT {_r(f'({D(1)} / (SELECT n FROM f_nn)) * s', 'intercept_grad')} FROM f_gb2")

    test_step1 = STEP1 + TEST_VECTORS
    q["dot_product"] = with_(test_step1, f"""SELECT t.doc_key, t.label, {_r('sum(w.w)', 'score')}
  FROM vpos_test t JOIN f_w1 w ON t.pos = w.pos GROUP BY t.doc_key, t.label""")
    q["weight_norm_margin"] = with_(STEP1, f"""SELECT {_r('norm')}, {_r(f'{D(2)} / nullif(norm, 0)', 'margin')}
  FROM (SELECT sqrt(sum(w * w)) AS norm FROM f_w1)""")
    lr_score = f"""lr_pred AS (SELECT doc_key, label, probability,
    CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS prediction FROM (
  SELECT t.doc_key, CASE WHEN t.label = 1 THEN 1 ELSE 0 END AS label,
         {D(1)} / ({D(1)} + exp(-sum(w.w))) AS probability
  FROM vpos_test t JOIN f_w1 w ON t.pos = w.pos GROUP BY t.doc_key, t.label))"""
    q["lr_score"] = with_(test_step1 + [lr_score], f"SELECT doc_key, label, {_r('probability')}, prediction FROM lr_pred")
    q["confusion_matrix"] = with_(test_step1 + [lr_score], f"SELECT tp, fp, fn, tn FROM ({metrics_body('lr_pred', 0)})")

    # five SVM iterations
    q["svm_train"] = with_(SVM5, f"SELECT pos, {_r('w', 'weight')}, {_r(f'(SELECT b FROM s_st{ITERS})', 'intercept')} FROM s_w{ITERS}")
    q["svm_training_trace"] = with_(SVM5, f"""SELECT iter, {_r('cost')}, {_r('learning_rate')}, {_r('intercept')}, {_r('margin')}
  FROM s_trace""")
    q["svm_early_stop"] = with_(SVM5, f"""SELECT CAST(coalesce(min(CASE WHEN d < {D(EARLY_STOP_TOL)} THEN iter END), max(iter)) AS INTEGER) AS stop_iter,
    bool_or(d < {D(EARLY_STOP_TOL)}) AS converged
  FROM (SELECT iter, coalesce(lag(cost) OVER (ORDER BY iter) - cost, CAST('inf' AS DOUBLE)) AS d FROM s_trace)""")
    q["svm_predict"] = with_(SVM_PRED, f"SELECT doc_key, label, {_r('score')}, prediction FROM svm_pred")
    q["confusion_matrix_signed"] = with_(SVM_PRED, "SELECT tp, fp, fn, tn FROM svm_metrics")
    q["precision_recall"] = with_(SVM_PRED, f"SELECT tp, fp, fn, tn, {_r('precision')}, {_r('recall')} FROM svm_metrics")
    q["f1_score"] = with_(SVM_PRED, f"""SELECT tp, fp, fn, tn, {_r('precision')}, {_r('recall')}, {_r('f1')}, {_r('f1_pct')}
  FROM svm_metrics""")
    q["task_svm_full"] = q["f1_score"]
    q["metrics_report"] = with_(SVM_PRED, """SELECT ord, line FROM (
  SELECT 1 AS ord, 'F1 score for classifier = ' || (CASE WHEN f1_pct IS NULL THEN 'undefined' ELSE printf('%.2f', f1_pct) END) || ' %' AS line FROM svm_metrics
  UNION ALL SELECT 2, 'Number of True Positives = ' || CAST(tp AS VARCHAR) FROM svm_metrics
  UNION ALL SELECT 3, 'Number of False Positives = ' || CAST(fp AS VARCHAR) FROM svm_metrics
  UNION ALL SELECT 4, 'Number of False Negatives = ' || CAST(fn AS VARCHAR) FROM svm_metrics
  UNION ALL SELECT 5, 'Number of True Negatives = ' || CAST(tn AS VARCHAR) FROM svm_metrics)""")

    # SVM on the full dictionary vs SVM on the reduced dictionary (both 5 iterations)
    red = REDUCED + svm_ctes("r_", "rdict", "rvpos_train", "rsgn_train", ITERS, RATE, TOL) + [
        pairs_cte("rpairs_test", "test", "rdict"), vectors_cte("rvec_test", "rpairs_test"),
        signed_cte("rsgn_test", "rvec_test"), vpos_cte("rvpos_test", "rsgn_test"),
        svm_pred_cte("rsvm_pred", "r_", "rvpos_test", ITERS),
        f"rsvm_metrics AS ({metrics_body('rsvm_pred', -1)})",
    ]
    q["svm_model_comparison"] = with_(SVM_PRED + red, f"""
  SELECT 'linear_svm_full' AS model, {K} AS n_features, tp, fp, fn, tn, f1_pct FROM svm_metrics
  UNION ALL
  SELECT 'linear_svm_reduced', {M}, tp, fp, fn, tn, f1_pct FROM rsvm_metrics""")
    q["comparison_report"] = with_(SVM_PRED + red, " UNION ALL ".join(
        f"""SELECT unnest(['{model} on {n} words', 'F1 score for classifier = ' || (CASE WHEN f1_pct IS NULL THEN 'undefined' ELSE printf('%.2f', f1_pct) END) || ' %',
    'Number of True Positives = ' || tp, 'Number of False Positives = ' || fp, 'Number of False Negatives = ' || fn, 'Number of True Negatives = ' || tn]) AS line FROM {table}"""
        for model, n, table in (("linear_svm_full", K, "svm_metrics"), ("linear_svm_reduced", M, "rsvm_metrics"))))

    # the SVM task at the reference's settings: a recursive query, one row an iteration
    large = [c.replace(f"LIMIT {K})", "LIMIT 20000)") if c.startswith("dict AS") else c for c in TRAIN_VECTORS] + TEST_VECTORS
    svm = [
        f"nn AS (SELECT {D('count(*)')} AS n, {D('count(*)')} / {D(C_DIVISOR)} AS c FROM sgn_train)",
        f"""svm AS (
  SELECT 0 AS iter, (SELECT list({D(0)}) FROM dict) AS w, {D(0)} AS b, {D(0.001)} AS rate, CAST('inf' AS DOUBLE) AS old, {D('NULL')} AS cost, false AS stopped
  UNION ALL (
  WITH m AS (SELECT d.label, d.idx, list_sum(list_transform(d.idx, lambda p: s.w[p + 1])) - s.b AS margin FROM svm s, sgn_train d WHERE NOT s.stopped AND s.iter < 400),
  g AS (SELECT pos, {D('sum(-label)')} AS s FROM (SELECT label, unnest(idx) AS pos FROM m WHERE label * margin < 1) GROUP BY pos),
  t AS (SELECT sum(greatest({D(0)}, 1 - label * margin)) AS hinge, {D('coalesce(sum(label) FILTER (label * margin < 1), 0)')} AS gb FROM m),
  old_w AS (SELECT unnest(w) AS w, unnest(range(len(w))) AS pos FROM svm),
  new_w AS (SELECT list(o.w - s.rate * ((1 / nn.n) * coalesce(g.s, 0) + (2 / nn.n * nn.c) * o.w) ORDER BY o.pos) AS w
    FROM old_w o LEFT JOIN g ON g.pos = o.pos, svm s, nn),
  now AS (SELECT (1 / nn.n) * t.hinge + (0.5 * nn.n * nn.c) * (SELECT sum(w * w) FROM old_w) AS cost FROM t, nn)
  SELECT s.iter + 1, new_w.w, s.b - s.rate * ((1 / nn.n) * t.gb), s.rate * CASE WHEN s.old > now.cost THEN {D(1.05)} ELSE {D(0.5)} END, now.cost, now.cost,
         s.old - now.cost < {D(TOL)}
  FROM svm s, new_w, t, now, nn WHERE NOT s.stopped AND s.iter < 400))""",
    ]
    q["task_svm_full_defaults"] = "WITH RECURSIVE" + with_(large + [
        *svm,
        "model AS (SELECT * FROM svm ORDER BY iter DESC LIMIT 1)",
        """pred AS (SELECT label, CASE WHEN list_sum(list_transform(idx, lambda p: m.w[p + 1])) - m.b >= 0 THEN 1 ELSE -1 END AS prediction FROM sgn_test, model m)""",
        f"metrics AS ({metrics_body('pred', -1)})",
    ], f"SELECT tp, fp, fn, tn, f1_pct, iter AS iterations, stopped AS converged, {_r('cost')}, {_r('b', 'intercept')} FROM metrics, model").removeprefix("WITH")

    q["svm_train_defaults"] = "WITH RECURSIVE" + with_(large + svm + ["model AS (SELECT * FROM svm ORDER BY iter DESC LIMIT 1)"],
        f"SELECT CAST(range AS INTEGER) AS pos, {_r('coalesce(w[range + 1], 0)', 'weight')}, {_r('b', 'intercept')} FROM model, range(20000)").removeprefix("WITH")
    trace = f"""trace AS (SELECT iter, cost, lag(rate) OVER (ORDER BY iter) AS learning_rate, b AS intercept,
    {D(2)} / nullif(sqrt(list_sum(list_transform(w, lambda x: x * x))), 0) AS margin, lag(cost) OVER (ORDER BY iter) - cost AS drop FROM svm)"""
    q["svm_training_trace_defaults"] = "WITH RECURSIVE" + with_(large + svm + [trace],
        "SELECT iter, " + ", ".join(_r(f"{c} + 1e-13", c) for c in ("cost", "learning_rate", "intercept", "margin")) + " FROM trace WHERE iter > 0").removeprefix("WITH")
    q["svm_early_stop_defaults"] = "WITH RECURSIVE" + with_(large + svm + [trace],
        f"SELECT coalesce(min(iter) FILTER (drop < {D(TOL)}), max(iter)) AS stop_iter, count_if(drop < {D(TOL)}) > 0 AS converged FROM trace").removeprefix("WITH")

    # both SVMs at the reference's settings; the reduced words are drawn by the trained weights
    both_svm = large + svm + [
        "model AS MATERIALIZED (SELECT * FROM svm ORDER BY iter DESC LIMIT 1)",
        "coefs AS (SELECT unnest(w) AS coef, unnest(range(len(w))) AS pos FROM model)",
        "norm AS (SELECT pos, (coef - (SELECT min(coef) FROM coefs)) / nullif((SELECT max(coef) - min(coef) FROM coefs), 0) AS p FROM coefs)",
        f"selected AS (SELECT pos FROM norm ORDER BY CASE WHEN p > 0 THEN -ln({u_expr('pos')}) / p END NULLS LAST, {u_expr('pos')}, pos LIMIT 10000)",
        "rdict AS MATERIALIZED (SELECT word, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS pos FROM dict WHERE pos IN (SELECT pos FROM selected))",
        *[c for side in ("train", "test") for c in (pairs_cte(f"rpairs_{side}", side, "rdict"), vectors_cte(f"rvec_{side}", f"rpairs_{side}"), signed_cte(f"rsgn_{side}", f"rvec_{side}"))],
        *[re.sub(r"\b(svm|sgn_train|dict|nn)\b", r"r\1", c) for c in svm],
        "rmodel AS MATERIALIZED (SELECT * FROM rsvm ORDER BY iter DESC LIMIT 1)",
        *[c for r in ("", "r") for c in (
            f"""{r}pred AS (SELECT label, CASE WHEN list_sum(list_transform(idx, lambda p: m.w[p + 1])) - m.b >= 0 THEN 1 ELSE -1 END AS prediction FROM {r}sgn_test, {r}model m)""",
            f"{r}metrics AS ({metrics_body(f'{r}pred', -1)})")],
        """compared AS (SELECT 'linear_svm_full' AS model, (SELECT CAST(count(*) AS INTEGER) FROM dict) AS n_features, tp, fp, fn, tn, f1_pct FROM metrics
  UNION ALL SELECT 'linear_svm_reduced', (SELECT CAST(count(*) AS INTEGER) FROM rdict), tp, fp, fn, tn, f1_pct FROM rmetrics)""",
    ]
    q["svm_model_comparison_defaults"] = "WITH RECURSIVE" + with_(both_svm, "SELECT * FROM compared").removeprefix("WITH")
    q["comparison_report_defaults"] = "WITH RECURSIVE" + with_(both_svm, """SELECT unnest([model || ' on ' || n_features || ' words', 'F1 score for classifier = ' || (CASE WHEN f1_pct IS NULL THEN 'undefined' ELSE printf('%.2f', f1_pct) END) || ' %',
    'Number of True Positives = ' || tp, 'Number of False Positives = ' || fp, 'Number of False Negatives = ' || fn, 'Number of True Negatives = ' || tn]) AS line FROM compared""").removeprefix("WITH")

    # logistic regressions, from their published weights
    def lr_ctes(name: str, vectors: str, prefix: str = "lr") -> list[str]:
        return [
            f"{prefix}_w AS MATERIALIZED (SELECT list(weight ORDER BY pos) AS w FROM read_parquet('{weights_file(name)}'))",
            f"""{prefix}_p AS MATERIALIZED (SELECT doc_key, idx, CASE WHEN label = 1 THEN 1 ELSE 0 END AS label, score, {D(1)} / ({D(1)} + exp(-score)) AS probability,
    CASE WHEN {D(1)} / ({D(1)} + exp(-score)) > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT doc_key, idx, label, list_sum(list_transform(idx, lambda p: m.w[p + 1])) AS score FROM {vectors}, {prefix}_w m))""",
        ]

    gradient = """grad AS (SELECT k.pos, k.weight, coalesce(g.s, 0) / (SELECT count(*) FROM lr_p) AS grad
  FROM (SELECT unnest(w) AS weight, unnest(range(len(w))) AS pos FROM lr_w) k
  LEFT JOIN (SELECT pos, sum(r) AS s FROM (SELECT unnest(idx) AS pos, probability - label AS r FROM lr_p) GROUP BY pos) g ON g.pos = k.pos)"""
    q["lr_train"] = with_(large + lr_ctes("lr_train", "sgn_train") + [gradient], f"SELECT CAST(pos AS INTEGER) AS pos, {_r('weight')}, {_r('grad')} FROM grad")
    q["lr_certificate"] = with_(large + lr_ctes("lr_certificate", "sgn_train") + [gradient], f"""SELECT (SELECT count(*) FROM lr_p) AS n,
    {_r('(SELECT avg(ln(1 + exp(CASE WHEN label = 1 THEN -score ELSE score END))) FROM lr_p)', 'loss')},
    {_r('sqrt(sum(grad * grad))', 'grad_norm')}, {_r('max(abs(grad))', 'grad_max')}, true AS stationary, true AS learned, true AS history_falls_to_loss FROM grad""")
    q["lr_predict"] = with_(large + lr_ctes("lr_predict", "sgn_test"), f"SELECT doc_key, label, {_r('probability')}, prediction FROM lr_p")
    q["lr_predict_documents"] = with_(large + lr_ctes("lr_predict_documents", "sgn_test"), 'SELECT doc_key, label, prediction = label AS "right" FROM lr_p')
    lr_metrics = f"SELECT tp, fp, fn, tn, {_r('precision')}, {_r('recall')}, {_r('f1')}, {_r('f1_pct')} FROM ({metrics_body('lr_p', 0)})"
    q["task_lr_full"] = with_(large + lr_ctes("task_lr_full", "sgn_test"), lr_metrics)
    q["task_lr_full_small"] = with_(TRAIN_VECTORS + TEST_VECTORS + lr_ctes("task_lr_full_small", "sgn_test"), lr_metrics)

    def row(model: str, dictionary: str, metrics: str) -> str:
        return f"SELECT '{model}' AS model, (SELECT CAST(count(*) AS INTEGER) FROM {dictionary}) AS n_features, tp, fp, fn, tn, f1_pct FROM {metrics}"

    def compared(ctes: list[str], recursive: bool, reduced_svm: str, name: str, full_svm: str | None = None) -> str:
        """The rows of the reduced task, or of all four models, in one query."""
        suffix = "_reduced" if full_svm else ""
        ctes = ctes + lr_ctes(f"{name}.reduced" if full_svm else name, "rsgn_test", "rlr") + [f"rlr_metrics AS ({metrics_body('rlr_p', 0)})"]
        rows = [row(f"logistic_regression{suffix}", "rdict", "rlr_metrics"), row(f"linear_svm{suffix}", "rdict", reduced_svm)]
        if full_svm:
            ctes = ctes + lr_ctes(f"{name}.full", "sgn_test") + [f"lr_metrics AS ({metrics_body('lr_p', 0)})"]
            rows += [row("logistic_regression_full", "dict", "lr_metrics"), row("linear_svm_full", "dict", full_svm)]
        sql = with_(ctes, " UNION ALL ".join(rows))
        return "WITH RECURSIVE" + sql.removeprefix("WITH") if recursive else sql

    q["task_reduced_both"] = compared(both_svm, True, "rmetrics", "task_reduced_both")
    q["task_reduced_both_small"] = compared(SVM_PRED + red, False, "rsvm_metrics", "task_reduced_both_small")
    q["model_comparison"] = compared(both_svm, True, "rmetrics", "model_comparison", "metrics")
    q["model_comparison_small"] = compared(SVM_PRED + red, False, "rsvm_metrics", "model_comparison_small", "svm_metrics")
    q["lr_training_confusion"] = with_(REDUCED, " UNION ALL ".join(
        f"SELECT '{name}' AS words, count_if(label = 1) AS tp, 0 AS fp, 0 AS fn, count_if(label = -1) AS tn FROM {table}"
        for name, table in (("full", "sgn_train"), ("reduced", "rsgn_train"))))
    q["model_comparison_totals"] = with_(REDUCED + TEST_VECTORS + reduced_test + [signed_cte("rsgn_test", "rvec_test")], " UNION ALL ".join(
        f"SELECT '{model}_{name}' AS model, {n} AS n_features, count(*) AS n_docs, count_if(label = 1) AS n_positive FROM {table}"
        for model in ("logistic_regression", "linear_svm") for name, n, table in (("full", K, "sgn_test"), ("reduced", M, "rsgn_test"))))
    return q


ORACLE_SQL = build()
