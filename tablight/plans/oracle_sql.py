"""Oracle SQL (DuckDB dialect) for the driver-table queries.

Each string recomputes the query's result from the raw driver tables with
plain SQL -- window functions, ``median``/``quantile_cont``, ``corr`` and
``md5`` -- as an independent check of the Spark operators. Floating results
are rounded to 6 places on both sides.
"""

from __future__ import annotations

from tablight.functions.columns import NUMERIC_TEXT
from tablight.plans.survey import (
    AREA_MAP,
    EDUCATION_MAP,
    GENDER_DEFAULT,
    GENDER_REPLACE,
    LABEL_MAP,
    VALID_GENDERS,
    YES_NO_MAP,
    dirty_survey_sql,
)


def q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def case(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} END)"


def num(expr: str) -> str:
    return f"(CASE WHEN regexp_matches({expr}, '{NUMERIC_TEXT}') THEN TRY_CAST(trim({expr}) AS DOUBLE) END)"


def mode_of(col: str) -> str:
    return f"(SELECT {col} FROM m WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


def _gender(expr: str) -> str:
    rep = f"coalesce({case(f'lower({expr})', GENDER_REPLACE)}, lower({expr}))"
    valid = ", ".join(q(v) for v in VALID_GENDERS)
    return f"(CASE WHEN {rep} IN ({valid}) THEN {rep} ELSE {q(GENDER_DEFAULT)} END)"


CLEAN_CTES = f"""d AS ({dirty_survey_sql()}),
m AS (
  SELECT row_id,
    {num('income')} AS income,
    {case('area', AREA_MAP)} AS area,
    {case('employed', YES_NO_MAP)} AS employed,
    {case('education', EDUCATION_MAP)} AS education,
    {case('home_owner', YES_NO_MAP)} AS home_owner,
    {_gender('gender')} AS gender,
    {num('balance')} AS balance,
    {num('age')} AS age,
    colour,
    CAST({case(case('fraud', YES_NO_MAP), LABEL_MAP)} AS DOUBLE) AS fraud
  FROM d),
s AS (SELECT median(income) AS income, median(balance) AS balance, avg(age) AS age FROM m),
clean AS (
  SELECT row_id,
    coalesce(m.income, s.income) AS income,
    coalesce(m.area, {mode_of('area')}) AS area,
    coalesce(m.employed, {mode_of('employed')}) AS employed,
    coalesce(m.education, {mode_of('education')}) AS education,
    coalesce(m.home_owner, {mode_of('home_owner')}) AS home_owner,
    coalesce(m.gender, {q(GENDER_DEFAULT)}) AS gender,
    coalesce(m.balance, s.balance) AS balance,
    coalesce(m.age, s.age) AS age,
    coalesce(m.colour, {mode_of('colour')}) AS colour,
    coalesce(m.fraud, {mode_of('fraud')}, CAST(0.0 AS DOUBLE)) AS fraud
  FROM m CROSS JOIN s)"""


def with_clean(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {CLEAN_CTES}{extra}\n{body}"


# Categories of the cleaned survey view, in one-hot order (values sorted).
ONE_HOT_LEVELS = {
    "area": ["Rural", "Urban"],
    "employed": ["No", "Yes"],
    "education": ["College", "School", "University"],
    "home_owner": ["No", "Yes"],
    "gender": ["Female", "Male", "Prefer not to say"],
    "colour": ["Black", "Blue", "Green", "Grey", "Pink", "Purple", "Red", "White", "White ", "Yellow"],
}

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CHI_FEATURES = ["education", "gender", "area", "home_owner", "employed"]

# documents with a label: deterministic score and prediction for evaluation queries
DOC_PRED_SQL = """docs AS (
  SELECT d.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
pred AS (
  SELECT doc_id, label, score,
    CASE WHEN score > (SELECT avg(score) FROM docs) THEN 1 ELSE 0 END AS prediction
  FROM docs)"""


def _describe_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem"""
        for c in LINEITEM_NUMERIC
    ]
    return "\nUNION ALL\n".join(parts)


def _corr_sql() -> str:
    parts = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in LINEITEM_NUMERIC
        for b in LINEITEM_NUMERIC
    ]
    return "\nUNION ALL\n".join(parts)


def _chi_sql() -> str:
    long = "\n  UNION ALL\n  ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, fraud AS y FROM clean" for c in CHI_FEATURES
    )
    ctes = f"""lng AS (
  {long}),
cells AS (SELECT feature, value, y, count(*) AS o FROM lng GROUP BY feature, value, y),
vals AS (SELECT DISTINCT feature, value FROM cells),
ys AS (SELECT DISTINCT feature, y FROM cells),
dense AS (
  SELECT v.feature, v.value, ys.y, CAST(coalesce(c.o, 0) AS DOUBLE) AS o
  FROM vals v JOIN ys ON v.feature = ys.feature
  LEFT JOIN cells c ON c.feature = v.feature AND c.value = v.value AND c.y = ys.y),
rt AS (SELECT feature, value, sum(o) AS rt FROM dense GROUP BY feature, value),
ct AS (SELECT feature, y, sum(o) AS ct FROM dense GROUP BY feature, y),
nn AS (SELECT feature, sum(o) AS n, count(DISTINCT value) AS r, count(DISTINCT y) AS c FROM dense GROUP BY feature),
e AS (
  SELECT dense.feature, dense.o, rt.rt * ct.ct / nn.n AS e, CAST((nn.r - 1) * (nn.c - 1) AS INTEGER) AS dof
  FROM dense
  JOIN rt ON rt.feature = dense.feature AND rt.value = dense.value
  JOIN ct ON ct.feature = dense.feature AND ct.y = dense.y
  JOIN nn ON nn.feature = dense.feature)"""
    body = """SELECT feature,
  round(sum(CASE WHEN dof = 1 THEN power(abs(o - e) - least(0.5, abs(o - e)), 2) / e
                 ELSE power(o - e, 2) / e END), 6) AS chi2,
  max(dof) AS dof
FROM e GROUP BY feature"""
    return with_clean(body, ctes)


def _one_hot_sql() -> str:
    dummies = []
    for c, levels in ONE_HOT_LEVELS.items():
        for v in levels:
            name = f"{c}_{v}".replace('"', '""')
            dummies.append(f'CASE WHEN {c} = {q(v)} THEN 1 ELSE 0 END AS "{name}"')
    cols = ",\n  ".join(dummies)
    return with_clean(
        f"""SELECT row_id, round(income, 6) AS income, round(balance, 6) AS balance, round(age, 6) AS age,
  {cols}
FROM clean"""
    )


def _report_sql() -> str:
    ctes = f"""{DOC_PRED_SQL},
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
per AS (
  SELECT c,
    (SELECT count(*) FROM pred WHERE label = c AND prediction = c) AS tp,
    (SELECT count(*) FROM pred WHERE label = c) AS support,
    (SELECT count(*) FROM pred WHERE prediction = c) AS predicted
  FROM cls),
m2 AS (
  SELECT c, support,
    CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
    CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r
  FROM per),
m3 AS (SELECT c, support, p, r, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM m2),
tot AS (SELECT sum(support) AS n FROM m3)"""
    body = """SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM m3
UNION ALL
SELECT 'accuracy', NULL, NULL, round((SELECT count(*) FROM pred WHERE label = prediction) / (SELECT n FROM tot), 6),
  CAST((SELECT n FROM tot) AS BIGINT)
UNION ALL
SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST((SELECT n FROM tot) AS BIGINT) FROM m3
UNION ALL
SELECT 'weighted avg', round(sum(p * support) / (SELECT n FROM tot), 6), round(sum(r * support) / (SELECT n FROM tot), 6),
  round(sum(f * support) / (SELECT n FROM tot), 6), CAST((SELECT n FROM tot) AS BIGINT) FROM m3"""
    return f"WITH {ctes}\n{body}"


_ROC_CTES = f"""{DOC_PRED_SQL},
g AS (SELECT score AS threshold, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM pred GROUP BY score),
c AS (
  SELECT threshold, pos, neg,
    sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
    sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
  FROM g),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g)"""


def _describe_survey_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM clean"""
        for c in ("income", "balance", "age")
    ]
    return with_clean("\nUNION ALL\n".join(parts))


SQL: dict[str, str] = {
    "clean_survey": with_clean(
        """SELECT row_id, round(income, 6) AS income, area, employed, education, home_owner, gender,
  round(balance, 6) AS balance, round(age, 6) AS age, colour, fraud FROM clean"""
    ),
    "table_shapes": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
        f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS n_cols"
        for t in (
            "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
        ).split()
    ),
    "distinct_area_raw": f"WITH d AS ({dirty_survey_sql()}) SELECT DISTINCT area FROM d",
    "value_counts_events": """SELECT event_type, count(*) AS n,
  round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct
FROM events GROUP BY event_type""",
    "value_counts_education": with_clean(
        """SELECT education, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct
FROM clean GROUP BY education"""
    ),
    "class_imbalance_survey": with_clean(
        """SELECT count_if(fraud = 1) AS positives, count_if(fraud = 0) AS negatives,
  round(CASE WHEN count_if(fraud = 0) = 0 THEN NULL ELSE count_if(fraud = 1) / count_if(fraud = 0) END, 6) AS ratio
FROM clean"""
    ),
    "describe_lineitem": _describe_sql(),
    "table_info_survey": with_clean(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS col_name, {i} AS position, '{t}' AS dtype, count({c}) AS non_null FROM clean"
            for i, (c, t) in enumerate(
                [
                    ("row_id", "bigint"), ("income", "double"), ("area", "string"), ("employed", "string"),
                    ("education", "string"), ("home_owner", "string"), ("gender", "string"),
                    ("balance", "double"), ("age", "double"), ("colour", "string"), ("fraud", "double"),
                ]
            )
        )
    ),
    "before_after_age": with_clean(
        """SELECT b.value, b.n_before, coalesce(a.n_after, 0) AS n_after
FROM b LEFT JOIN a ON a.value = b.value""",
        f"""b AS (SELECT coalesce(printf('%.1f', {num('age')}), 'nan') AS value, count(*) AS n_before FROM d GROUP BY 1),
a AS (SELECT coalesce(printf('%.1f', age), 'nan') AS value, count(*) AS n_after FROM clean GROUP BY 1)""",
    ),
    "grouped_counts_education": with_clean(
        "SELECT education, fraud, count(*) AS n FROM clean GROUP BY education, fraud"
    ),
    "crosstab_lineitem": """WITH a AS (SELECT DISTINCT l_returnflag FROM lineitem),
b AS (SELECT DISTINCT l_linestatus FROM lineitem),
c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT a.l_returnflag, b.l_linestatus, coalesce(c.n, 0) AS n
FROM a CROSS JOIN b LEFT JOIN c ON c.l_returnflag = a.l_returnflag AND c.l_linestatus = b.l_linestatus""",
    "chi_square_survey": _chi_sql(),
    "correlation_lineitem": _corr_sql(),
    "box_stats_lineitem": """WITH qs AS (
  SELECT l_returnflag AS grp, count(*) AS n,
    quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
    quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem GROUP BY l_returnflag),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM qs)
SELECT f.grp, f.n, round(f.q1, 6) AS q1, round(f.med, 6) AS median, round(f.q3, 6) AS q3,
  round(f.q3 - f.q1, 6) AS iqr,
  round(min(CASE WHEN l.l_extendedprice >= f.lo_f THEN l.l_extendedprice END), 6) AS whisker_lo,
  round(max(CASE WHEN l.l_extendedprice <= f.hi_f THEN l.l_extendedprice END), 6) AS whisker_hi,
  count_if(l.l_extendedprice < f.lo_f OR l.l_extendedprice > f.hi_f) AS n_outliers
FROM lineitem l JOIN f ON l.l_returnflag = f.grp
GROUP BY f.grp, f.n, f.q1, f.med, f.q3""",
    "histogram_lineitem": """WITH s AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
w AS (SELECT mn, mx, (mx - mn) / 30 AS w FROM s),
b AS (SELECT least(CAST(floor((l_extendedprice - mn) / w) AS INTEGER), 29) AS bin FROM lineitem, w),
cnt AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
ids AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT ids.bin, round(w.mn + ids.bin * w.w, 6) AS lo, round(w.mn + (ids.bin + 1) * w.w, 6) AS hi,
  coalesce(cnt.n, 0) AS n
FROM ids CROSS JOIN w LEFT JOIN cnt ON cnt.bin = ids.bin""",
    "histogram_info_lineitem": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col_name, count({c}) AS n, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
        f"min({c}) > 0 AS log_scale_ok FROM lineitem"
        for c in LINEITEM_NUMERIC
    ),
    "select_numeric_lineitem": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
  round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax FROM lineitem""",
    "stratified_folds_dirty": f"""WITH d AS ({dirty_survey_sql()}),
e AS (SELECT row_id, CASE WHEN row_id % 7 <> 0 THEN fraud END AS label FROM d)
SELECT row_id, label,
  CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1) % 5 AS INTEGER) AS fold
FROM e""",
    "box_stats_dirty": """WITH d AS (
  SELECT l_returnflag AS grp, l_extendedprice AS price FROM lineitem WHERE l_linenumber NOT IN (3, 4, 5)),
qs AS (
  SELECT grp, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS med, quantile_cont(price, 0.75) AS q3
  FROM d GROUP BY grp),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM qs)
SELECT f.grp, f.n, round(f.q1, 6) AS q1, round(f.med, 6) AS median, round(f.q3, 6) AS q3, round(f.q3 - f.q1, 6) AS iqr,
  round(min(CASE WHEN d.price >= f.lo_f THEN d.price END), 6) AS whisker_lo,
  round(max(CASE WHEN d.price <= f.hi_f THEN d.price END), 6) AS whisker_hi,
  count_if(d.price < f.lo_f OR d.price > f.hi_f) AS n_outliers
FROM d JOIN f ON d.grp = f.grp GROUP BY f.grp, f.n, f.q1, f.med, f.q3""",
    "one_hot_survey": _one_hot_sql(),
    "standardize_survey": with_clean(
        """SELECT row_id,
  round((income - avg(income) OVER ()) / stddev_pop(income) OVER (), 6) AS income,
  round((balance - avg(balance) OVER ()) / stddev_pop(balance) OVER (), 6) AS balance,
  round((age - avg(age) OVER ()) / stddev_pop(age) OVER (), 6) AS age
FROM clean"""
    ),
    "train_test_split_orders": """SELECT o_orderkey,
  CASE WHEN substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split
FROM orders""",
    "train_test_split_exact": """SELECT o_orderkey,
  CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) <= ceil(0.2 * count(*) OVER ())
       THEN 'test' ELSE 'train' END AS split
FROM orders""",
    "split_counts_orders": """SELECT CASE WHEN substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) < '33333333'
  THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows
FROM orders GROUP BY 1""",
    "stratified_folds_survey": with_clean(
        """SELECT row_id, fraud,
  CAST((row_number() OVER (PARTITION BY fraud ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1) % 5 AS INTEGER) AS fold
FROM clean"""
    ),
    "confusion_matrix_docs": f"""WITH {DOC_PRED_SQL},
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
cnt AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL)
SELECT CAST(a.c AS VARCHAR) AS label, CAST(b.c AS VARCHAR) AS prediction, coalesce(cnt.n, 0) AS n
FROM cls a CROSS JOIN cls b LEFT JOIN cnt ON cnt.label = a.c AND cnt.prediction = b.c""",
    "classification_report_docs": _report_sql(),
    "accuracy_docs": f"""WITH {DOC_PRED_SQL}
SELECT count(*) AS n, count_if(label = prediction) AS correct,
  round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred""",
    "roc_curve_docs": f"""WITH {_ROC_CTES}
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS fpr, CAST(0.0 AS DOUBLE) AS tpr
UNION ALL
SELECT round(threshold, 6), round(cum_neg / (SELECT N FROM t), 6), round(cum_pos / (SELECT P FROM t), 6) FROM c""",
    "roc_auc_docs": f"""WITH {_ROC_CTES}
SELECT round(sum(neg * (2 * cum_pos - pos)) / (2.0 * (SELECT P FROM t) * (SELECT N FROM t)), 6) AS auc FROM c""",
    "top_k_users": """SELECT user_id, round(sum(value), 6) AS total_value, count(*) AS n_events
FROM events GROUP BY user_id ORDER BY sum(value) DESC, user_id LIMIT 10""",
    "best_row_part": """SELECT p_partkey, p_name, round(p_retailprice, 6) AS p_retailprice FROM part
ORDER BY p_retailprice DESC, p_partkey LIMIT 1""",
    "sort_results_supplier": """SELECT s_suppkey, s_name, round(s_acctbal, 6) AS s_acctbal FROM supplier
ORDER BY s_acctbal DESC""",
    "relabel_survey": with_clean(
        """SELECT CASE fraud WHEN 0.0 THEN 'Not Fraud' WHEN 1.0 THEN 'Fraud' END AS fraud_status, count(*) AS n
FROM clean GROUP BY 1"""
    ),
    "filter_rows_orders": """SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000.0""",
    "before_after_area": with_clean(
        """SELECT b.value, b.n_before, coalesce(a.n_after, 0) AS n_after
FROM b LEFT JOIN a ON a.value = b.value""",
        """b AS (SELECT coalesce(area, 'nan') AS value, count(*) AS n_before FROM d GROUP BY 1),
a AS (SELECT coalesce(area, 'nan') AS value, count(*) AS n_after FROM clean GROUP BY 1)""",
    ),
    "describe_survey": _describe_survey_sql(),
    "box_stats_survey": with_clean(
        """SELECT CAST(f.grp AS VARCHAR) AS grp, f.n, round(f.q1, 6) AS q1, round(f.med, 6) AS median, round(f.q3, 6) AS q3,
  round(f.q3 - f.q1, 6) AS iqr,
  round(min(CASE WHEN c.income >= f.lo_f THEN c.income END), 6) AS whisker_lo,
  round(max(CASE WHEN c.income <= f.hi_f THEN c.income END), 6) AS whisker_hi,
  count_if(c.income < f.lo_f OR c.income > f.hi_f) AS n_outliers
FROM clean c JOIN f ON c.fraud = f.grp
GROUP BY f.grp, f.n, f.q1, f.med, f.q3""",
        """qs AS (
  SELECT fraud AS grp, count(*) AS n, quantile_cont(income, 0.25) AS q1, quantile_cont(income, 0.5) AS med,
    quantile_cont(income, 0.75) AS q3
  FROM clean GROUP BY fraud),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM qs)""",
    ),
    "append_rows_parties": """SELECT 'customer' AS kind, c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey,
  round(c_acctbal, 6) AS acctbal, NULL::VARCHAR AS segment FROM customer WHERE false
UNION ALL
SELECT 'customer', c_custkey, c_name, c_nationkey, round(c_acctbal, 6), c_mktsegment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, round(s_acctbal, 6), NULL FROM supplier""",
}


# ---------------------------------------------------------------------------
# learning operators with an exact SQL equivalent
# ---------------------------------------------------------------------------

_HASH_SPLIT = "CASE WHEN substr(md5('42:' || CAST({k} AS VARCHAR)), 1, 8) < '33333333' THEN 'test' ELSE 'train' END"
_D2 = "list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) ^ 2))"


def _prepare_sql() -> str:
    feats = [("income", "income"), ("balance", "balance"), ("age", "age")]
    for c, levels in ONE_HOT_LEVELS.items():
        for v in levels:
            feats.append((f"{c}_{v}", f"CAST(CASE WHEN {c} = {q(v)} THEN 1 ELSE 0 END AS DOUBLE)"))
    wide = ",\n  ".join(f'{e} AS "{n}"' for n, e in feats)
    scaled = ",\n  ".join(
        f'round(("{n}" - avg(CASE WHEN split = \'train\' THEN "{n}" END) OVER ()) / '
        f'coalesce(nullif(stddev_pop(CASE WHEN split = \'train\' THEN "{n}" END) OVER (), 0), 1), 6) AS "{n}"'
        for n, _ in feats
    )
    return with_clean(
        f"SELECT row_id, split, label,\n  {scaled}\nFROM w",
        f"w AS (SELECT row_id, fraud AS label, {_HASH_SPLIT.format(k='row_id')} AS split,\n  {wide}\nFROM clean)",
    )


_EMB_PAIRS = f"""e AS (SELECT vec_id, embedding, label, {_HASH_SPLIT.format(k='vec_id')} AS split FROM embeddings),
d AS (
  SELECT q.vec_id AS qid, t.vec_id AS tid, t.label AS tlabel, {_D2.format(a='q.embedding', b='t.embedding')} AS d2
  FROM e q JOIN e t ON q.split = 'test' AND t.split = 'train'),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) - 1 AS rank FROM d)"""

SQL_MODELS: dict[str, str] = {
    "prepare_supervised_survey": _prepare_sql(),
    "knn_neighbors_embeddings": f"""WITH {_EMB_PAIRS}
SELECT qid AS vec_id, CAST(rank AS INTEGER) AS rank, tid AS neighbor_id FROM r WHERE rank < 5""",
    "knn_embeddings": f"""WITH {_EMB_PAIRS},
v AS (SELECT qid, tlabel, count(*) AS n FROM r WHERE rank < 5 GROUP BY qid, tlabel),
w AS (SELECT qid, tlabel, row_number() OVER (PARTITION BY qid ORDER BY n DESC, tlabel) AS pos FROM v)
SELECT e.vec_id, e.label, w.tlabel AS prediction FROM e JOIN w ON w.qid = e.vec_id AND w.pos = 1
WHERE e.split = 'test'""",
    "silhouette_embeddings_labels": f"""WITH p AS (
  SELECT a.vec_id AS i, a.label AS ci, b.label AS cj, sqrt({_D2.format(a='a.embedding', b='b.embedding')}) AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
m AS (SELECT i, ci, cj, avg(d) AS md FROM p GROUP BY i, ci, cj),
ab AS (SELECT i, max(CASE WHEN ci = cj THEN md END) AS a, min(CASE WHEN ci <> cj THEN md END) AS b FROM m GROUP BY i),
s AS (SELECT CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)
SELECT round(avg(s), 6) AS silhouette FROM s""",
    "dbscan_neighbors_embeddings": f"""WITH p AS (
  SELECT a.vec_id, {_D2.format(a='a.embedding', b='b.embedding')} AS d2 FROM embeddings a CROSS JOIN embeddings b)
SELECT vec_id, count_if(d2 <= 1.15 * 1.15) AS n_neighbors, count_if(d2 <= 1.15 * 1.15) >= 5 AS is_core
FROM p GROUP BY vec_id""",
}

SQL_MODELS["dbscan_core_counts_embeddings"] = f"""WITH p AS (
  SELECT a.vec_id, {_D2.format(a='a.embedding', b='b.embedding')} AS d2 FROM embeddings a CROSS JOIN embeddings b),
e AS (SELECT CAST(i AS DOUBLE) / 10 AS eps FROM range(3, 20) r(i)),
n AS (SELECT p.vec_id, e.eps, count_if(p.d2 <= e.eps * e.eps) AS n FROM p CROSS JOIN e GROUP BY ALL),
m AS (SELECT CAST(i AS INTEGER) AS min_samples FROM range(3, 10) r(i))
SELECT n.eps, m.min_samples, CAST(count_if(n.n >= m.min_samples) AS BIGINT) AS n_core FROM n CROSS JOIN m GROUP BY ALL"""

SQL_MODELS["dbscan_embeddings"] = f"""WITH RECURSIVE
nb AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a CROSS JOIN embeddings b
  WHERE {_D2.format(a='a.embedding', b='b.embedding')} <= 1.15 * 1.15),
cnt AS (SELECT a, count(*) AS n FROM nb GROUP BY a),
core AS (SELECT a AS id FROM cnt WHERE n >= 5),
edges AS (SELECT nb.a, nb.b FROM nb JOIN core c1 ON nb.a = c1.id JOIN core c2 ON nb.b = c2.id),
reach(id, root) AS (
  SELECT id, id FROM core
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.id),
comp AS (SELECT id, min(root) AS comp FROM reach GROUP BY id),
border AS (
  SELECT nb.a AS id, min(comp.comp) AS comp FROM nb JOIN comp ON nb.b = comp.id
  WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a),
lab AS (SELECT id, comp FROM comp UNION ALL SELECT id, comp FROM border),
num AS (SELECT comp, CAST(dense_rank() OVER (ORDER BY comp) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT comp FROM lab))
SELECT e.vec_id, coalesce(num.cluster, -1) AS cluster, e.vec_id IN (SELECT id FROM core) AS is_core
FROM embeddings e LEFT JOIN lab ON lab.id = e.vec_id LEFT JOIN num ON num.comp = lab.comp"""

SQL_MODELS["cluster_summary_dbscan_embeddings"] = (
    "SELECT CAST(count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS INTEGER) AS n_clusters, "
    "coalesce(max(cluster = -1), false) AS has_outliers FROM ("
    + SQL_MODELS["dbscan_embeddings"].replace("WITH RECURSIVE", "WITH RECURSIVE", 1)
    + ") t"
)

SQL_MODELS["knn_search_embeddings"] = f"""WITH e AS (SELECT vec_id, embedding, label, {_HASH_SPLIT.format(k='vec_id')} AS split FROM embeddings),
tr AS (
  SELECT vec_id, embedding, label,
    CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id) - 1) % 5 AS INTEGER) AS fold
  FROM e WHERE split = 'train'),
d AS (
  SELECT q.vec_id AS qid, q.label AS y, q.fold AS f, t.vec_id AS tid, t.label AS tlabel,
    {_D2.format(a='q.embedding', b='t.embedding')} AS d2
  FROM tr q JOIN tr t ON q.fold <> t.fold),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) - 1 AS rank FROM d),
ks AS (SELECT range AS k FROM range(1, 20)),
v AS (SELECT qid, y, f, k, tlabel, count(*) AS n FROM r JOIN ks ON r.rank < ks.k GROUP BY qid, y, f, k, tlabel),
w AS (SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY n DESC, tlabel) AS pos FROM v),
acc AS (SELECT k, f, avg(CASE WHEN tlabel = y THEN 1.0 ELSE 0.0 END) AS a FROM w WHERE pos = 1 GROUP BY k, f)
SELECT CAST(k AS INTEGER) AS k, round(avg(a), 6) AS cv_accuracy FROM acc GROUP BY k"""

SQL_MODELS["saved_bundles_survey"] = f"""WITH d AS ({dirty_survey_sql()}),
t AS (SELECT {_HASH_SPLIT.format(k='row_id')} AS split FROM d)
SELECT model, count(*) AS n_rows, count(*) AS n_equal
FROM t JOIN (VALUES ('Logistic Regression'), ('Random Forest'), ('Decision Tree'), ('KNN'), ('SVM'), ('Gradient Boosting')) m(model) ON t.split = 'test'
GROUP BY model"""

SQL["histogram_auto_lineitem"] = """WITH s AS (
  SELECT count(*) AS n, min(l_extendedprice) AS mn, max(l_extendedprice) AS mx,
    quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS iqr
  FROM lineitem),
w AS (
  SELECT *, (mx - mn) / (log2(n) + 1.0) AS sturges, 2.0 * iqr * pow(n, -1.0 / 3.0) AS fd FROM s),
b AS (
  SELECT *, CAST(ceil((mx - mn) / (CASE WHEN fd > 0 THEN least(sturges, fd) ELSE sturges END)) AS INTEGER) AS bins
  FROM w),
g AS (SELECT mn, bins, (mx - mn) / bins AS width FROM b),
x AS (SELECT least(CAST(floor((l_extendedprice - g.mn) / g.width) AS INTEGER), g.bins - 1) AS bin FROM lineitem, g),
cnt AS (SELECT bin, count(*) AS n FROM x GROUP BY bin),
ids AS (SELECT CAST(range AS INTEGER) AS bin FROM g, range(g.bins))
SELECT ids.bin, round(g.mn + ids.bin * g.width, 6) AS lo, round(g.mn + (ids.bin + 1) * g.width, 6) AS hi,
  coalesce(cnt.n, 0) AS n
FROM ids CROSS JOIN g LEFT JOIN cnt ON cnt.bin = ids.bin"""

SQL["value_counts_raw_area"] = f"""WITH d AS ({dirty_survey_sql()})
SELECT coalesce(area, 'nan') AS area, count(*) AS n FROM d GROUP BY 1"""
