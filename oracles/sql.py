"""SQL formulations for the correctness check.

Models are checked through closed forms: a PCA of two features, PLS of two features with
two components for any number of classes, and PLS of any features for two classes.
"""

from __future__ import annotations

from covaria.plans.bindings import (
    CAPITALS,
    DIGITS,
    DIRTY_FEATURES,
    LINE_FEATURES,
    LINE_KEYS,
    MARKS,
    TEXT_FEATURES,
)

KEYS = ", ".join(LINE_KEYS)


def r(expression: str, digits: int = 6) -> str:
    return f"floor(({expression}) * 1e{digits} + 0.5) / 1e{digits}"


def union_all(parts) -> str:
    return "\nUNION ALL ".join(parts)


# --- line tables ---------------------------------------------------------------------

DIRTY = f"""dirty AS (
  SELECT {KEYS}, {", ".join(LINE_FEATURES)},
    CAST(7.0 AS DOUBLE) AS d_const,
    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN CAST('NaN' AS DOUBLE)
         ELSE l_quantity END AS d_gaps,
    CASE WHEN l_linenumber = 3 THEN CAST('Infinity' AS DOUBLE)
         WHEN l_linenumber = 4 THEN CAST('-Infinity' AS DOUBLE) ELSE l_tax END AS d_inf,
    CAST(NULL AS DOUBLE) AS d_empty
  FROM lineitem)"""


def finite(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c}) THEN {c} END"


def column_profile() -> str:
    one = lambda c: f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
  count(CASE WHEN isnan({c}) THEN 1 END) AS n_nan, count(CASE WHEN isinf({c}) THEN 1 END) AS n_inf,
  {r(f"avg({finite(c)})", 7)} AS mean, {r(f"stddev_samp({finite(c)})", 7)} AS std_samp,
  {r(f"stddev_pop({finite(c)})", 7)} AS std_pop, {r(f"min({finite(c)})", 7)} AS min_value,
  {r(f"max({finite(c)})", 7)} AS max_value FROM dirty"""  # noqa: E731
    return f"WITH {DIRTY}\n" + union_all(one(c) for c in DIRTY_FEATURES)


def clean(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0::DOUBLE WHEN isinf({c}) THEN -1.0::DOUBLE ELSE {c} END AS {c}"
    )


def standardize(source: str, columns, impute: bool) -> str:
    def z(c):
        value = f"(({finite(c)}) - m_{c}) / s_{c}"
        return f"{r(f'coalesce({value}, 0.0)' if impute else value, 5)} AS {c}"

    stats = ", ".join(
        f"coalesce(avg({finite(c)}), 0) AS m_{c}, "
        f"CASE WHEN min({finite(c)}) < max({finite(c)}) THEN stddev_pop({finite(c)}) ELSE 1 END AS s_{c}"
        for c in columns
    )
    return f"""WITH {DIRTY}, st AS (SELECT {stats} FROM {source})
SELECT {KEYS}, {", ".join(z(c) for c in columns)} FROM {source}, st"""


def correlation_matrix() -> str:
    parts = [
        f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, "
        + r(f"avg((({a}) - (SELECT avg({a}) FROM lineitem)) * (({b}) - (SELECT avg({b}) FROM lineitem)))"
            f" / (stddev_pop({a}) * stddev_pop({b}))")
        + " AS correlation FROM lineitem"
        for i, a in enumerate(LINE_FEATURES)
        for b in LINE_FEATURES[i:]
    ]
    return union_all(parts)


def class_feature_sums() -> str:
    parts = [
        f"""SELECT l_linestatus AS label, count(*) AS n_rows, '{c}' AS feature,
  {r(f"sum(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem))")} AS z_sum
FROM lineitem GROUP BY l_linestatus"""
        for c in LINE_FEATURES
    ]
    return union_all(parts)


VECTOR_Z = """long AS (
  SELECT vec_id, CAST(label AS VARCHAR) AS label, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings),
st AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY i),
z AS (SELECT vec_id, label, long.i, (x - m) / s AS z FROM long JOIN st ON long.i = st.i)"""


# --- PCA of two features -------------------------------------------------------------


def pca2(source: str, a: str, b: str, extra: str = "") -> str:
    """CTEs: st (means, deviations), model (r, sign, eigenvalues) of features a and b.

    First component (z1 + s z2) / sqrt 2, second (z1 - s z2) / sqrt 2, s the sign of r.
    """
    return f"""{extra}st AS (SELECT avg({a}) AS ma, stddev_pop({a}) AS sa, avg({b}) AS mb, stddev_pop({b}) AS sb FROM {source}),
model AS (SELECT c, CASE WHEN c < 0 THEN -1.0 ELSE 1.0 END AS s FROM (
  SELECT avg(({a} - ma) / sa * (({b} - mb) / sb)) AS c FROM {source}, st))"""


SIZE = ("lineitem", "l_quantity", "l_extendedprice")


def pca_scores(source: str, a: str, b: str, keep: str, digits: int | None) -> str:
    z1, z2 = f"({a} - ma) / sa", f"({b} - mb) / sb"
    one, two = f"({z1} + s * ({z2})) / sqrt(2)", f"({z1} - s * ({z2})) / sqrt(2)"
    if digits is not None:
        one, two = r(one, digits), r(two, digits)
    return f"SELECT {keep}, {one} AS PC1, {two} AS PC2 FROM {source}, st, model"


def pca_fit() -> str:
    half = r("1 / sqrt(2)")
    second = r("s / sqrt(2)")
    return f"""WITH {pca2(*SIZE)}
SELECT 1 AS component, '{SIZE[1]}' AS feature, {half} AS loading
UNION ALL SELECT 1, '{SIZE[2]}', {second} FROM model
UNION ALL SELECT 2, '{SIZE[1]}', {half}
UNION ALL SELECT 2, '{SIZE[2]}', {r("-s / sqrt(2)")} FROM model"""


def pca_top_loadings() -> str:
    half = r("1 / sqrt(2)")
    return f"""WITH {pca2(*SIZE)}
SELECT 1 AS "rank", '{SIZE[1]}' AS pc1_feature, {half} AS pc1_loading, '{SIZE[1]}' AS pc2_feature, {half} AS pc2_loading
UNION ALL SELECT 2, '{SIZE[2]}', {r("s / sqrt(2)")}, '{SIZE[2]}', {r("-s / sqrt(2)")} FROM model"""


def pca_by_feature_group() -> str:
    def one(group, a, b):
        return f"""SELECT '{group}' AS group_id, 2 AS n_features, {r("(1 + abs(c)) / 2 * 100")} AS pc1_percent,
  {r("(1 - abs(c)) / 2 * 100")} AS pc2_percent FROM (SELECT corr({a}, {b}) AS c FROM lineitem)"""

    return union_all(
        [
            one("size", "l_quantity", "l_extendedprice"),
            one("rates", "l_discount", "l_tax"),
            one("mixed", "l_extendedprice", "l_tax"),
        ]
    )


# --- entities and pairs --------------------------------------------------------------

PAIRS = """pairs AS (
  SELECT DISTINCT chr(65 + c_nationkey) || chr(65 + s_nationkey) AS formula, l_returnflag AS structure
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

ENTITIES = """entities AS (
  SELECT chr(65 + n) AS "Symbol", a, b FROM
    (SELECT c_nationkey AS n, avg(c_acctbal) AS a FROM customer GROUP BY c_nationkey)
    JOIN (SELECT s_nationkey AS n, avg(s_acctbal) AS b FROM supplier GROUP BY s_nationkey) USING (n))"""


def entity_scores() -> str:
    return (
        f"{ENTITIES}, {pca2('entities', 'a', 'b')}, scores AS ("
        + pca_scores("entities", "a", "b", '"Symbol" AS sym', None)
        + ")"
    )


def pair_links() -> str:
    return f"""WITH {PAIRS}, {entity_scores()}
SELECT formula, structure, {r("a.PC1")} AS x0, {r("a.PC2")} AS y0, {r("b.PC1")} AS x1, {r("b.PC2")} AS y1,
  {r("(a.PC1 + b.PC1) / 2")} AS mid_x, {r("(a.PC2 + b.PC2) / 2")} AS mid_y
FROM pairs JOIN scores a ON a.sym = substr(formula, 1, 1) JOIN scores b ON b.sym = substr(formula, 2, 1)"""


def pair_link_counts() -> str:
    return f"""WITH {PAIRS}, {ENTITIES}
SELECT count(*) AS n_pairs, count(CASE WHEN a."Symbol" IS NOT NULL AND b."Symbol" IS NOT NULL THEN 1 END) AS n_links,
  count(CASE WHEN a."Symbol" IS NULL OR b."Symbol" IS NULL THEN 1 END) AS n_skipped
FROM pairs LEFT JOIN entities a ON a."Symbol" = substr(formula, 1, 1)
LEFT JOIN entities b ON b."Symbol" = substr(formula, 2, 1)"""


# Symbols of one letter and their categories.
LETTERS = """('K', 'alkali_metals'), ('V', 'transition_metals'), ('W', 'transition_metals'), ('Y', 'transition_metals'),
  ('U', 'actinides'), ('B', 'metalloids'), ('H', 'non_metals'), ('C', 'non_metals'), ('N', 'non_metals'),
  ('O', 'non_metals'), ('P', 'non_metals'), ('S', 'non_metals'), ('F', 'halogens'), ('I', 'halogens')"""

# Catalogue, group and number of its features, in order.
GROUP_SIZES = (
    ("samples", "index", 7),
    ("samples", "atomic_weight", 3),
    ("samples", "period_group", 5),
    ("samples", "mendeleev", 3),
    ("samples", "valence", 6),
    ("samples", "unpaired", 6),
    ("samples", "gilman", 6),
    ("samples", "z_eff", 8),
    ("samples", "ionization_energy", 8),
    ("samples", "coordination_number", 3),
    ("samples", "ratio_closest", 5),
    ("samples", "polyhedron_distortion", 5),
    ("samples", "cif_radius", 6),
    ("samples", "pauling_radius_cn12", 6),
    ("samples", "pauling_en", 8),
    ("samples", "martynov_batsanov_en", 8),
    ("samples", "melting_point", 8),
    ("samples", "density", 8),
    ("samples", "specific_heat", 8),
    ("samples", "cohesive_energy", 8),
    ("samples", "bulk_modulus", 8),
    ("entities", "basic_atomic_properties", 5),
    ("entities", "atomic_and_ionic_radii", 13),
    ("entities", "electronegativity_and_electron_affinity", 9),
    ("entities", "thermal_and_physical_properties", 10),
    ("entities", "electronic_structure", 15),
    ("entities", "dft_lsd_and_lda_properties", 10),
    ("entities", "dft_rlda_and_scrlda_properties", 10),
)


def catalog_on_vectors() -> str:
    groups = ", ".join(f"({i}, '{c}', '{g}', {n})" for i, (c, g, n) in enumerate(GROUP_SIZES))
    return f"""WITH groups(o, catalog, group_id, n) AS (VALUES {groups}),
placed AS (SELECT catalog, group_id, n, sum(n) OVER (PARTITION BY catalog ORDER BY o) - n AS first FROM groups),
entries AS (SELECT catalog, group_id, unnest(range(first::BIGINT, (first + n)::BIGINT)) % 64 AS i FROM placed),
means AS (SELECT i, avg(x) AS m FROM (SELECT unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings) GROUP BY i)
SELECT catalog, group_id, count(*) AS n_features, {r("sum(m)")} AS mean_sum FROM entries JOIN means USING (i) GROUP BY catalog, group_id"""


def category_lookup() -> str:
    return f"""WITH known(symbol, category) AS (VALUES {LETTERS})
SELECT c_custkey, chr(65 + c_nationkey) AS sign, coalesce(category, 'other') AS category
FROM customer LEFT JOIN known ON symbol = chr(65 + c_nationkey)"""


# --- PLS of two features, three classes ----------------------------------------------


def banded(scale: bool = True) -> str:
    """CTEs up to ``scored``: rows with z1, z2, scores t1, t2; ``model``: weights and variances."""
    f = "sqrt((n - 1) / n)" if scale else "1.0"
    sy = "sqrt(nc * (1 - nc / n) / (n - 1))" if scale else "1.0"
    return f"""bands AS (
  SELECT {KEYS}, l_quantity, l_extendedprice,
    CASE WHEN l_extendedprice < 35000 THEN 'low' WHEN l_extendedprice < 70000 THEN 'mid' ELSE 'high' END AS band
  FROM lineitem),
st AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2,
  stddev_pop(l_extendedprice) AS s2 FROM bands),
z AS (SELECT {KEYS}, band, (l_quantity - m1) / s1 AS z1, (l_extendedprice - m2) / s2 AS z2 FROM bands, st),
size AS (SELECT count(*)::DOUBLE AS n, sum(z1 * z2) AS g FROM z),
fac AS (SELECT n, {f} AS f, n * ({f}) * ({f}) AS g11, g * ({f}) * ({f}) AS g12 FROM size),
cls AS (SELECT band, nc, nc / n AS share, {sy} AS sy, s1 * f / {sy} AS c1, s2 * f / {sy} AS c2
  FROM (SELECT band, count(*)::DOUBLE AS nc, sum(z1) AS s1, sum(z2) AS s2 FROM z GROUP BY band), fac),
ang AS (SELECT 0.5 * atan2(2 * sum(c1 * c2), sum(c1 * c1) - sum(c2 * c2)) AS th FROM cls),
raw AS (SELECT cos(th) AS a, sin(th) AS b FROM ang),
w AS (SELECT k1 * a AS w11, k1 * b AS w12, -k2 * b AS w21, k2 * a AS w22 FROM (
  SELECT a, b, CASE WHEN abs(a) >= abs(b) THEN sign(a) ELSE sign(b) END AS k1,
    CASE WHEN abs(b) >= abs(a) THEN sign(-b) ELSE sign(a) END AS k2 FROM raw)),
t1m AS (SELECT *, w11 * w11 * g11 + 2 * w11 * w12 * g12 + w12 * w12 * g11 AS tt1 FROM w, fac),
p1m AS (SELECT *, (g11 * w11 + g12 * w12) / tt1 AS p11, (g12 * w11 + g11 * w12) / tt1 AS p12 FROM t1m),
r2m AS (SELECT *, w21 - (p11 * w21 + p12 * w22) * w11 AS r21, w22 - (p11 * w21 + p12 * w22) * w12 AS r22 FROM p1m),
model AS (SELECT *, r21 * r21 * g11 + 2 * r21 * r22 * g12 + r22 * r22 * g11 AS tt2 FROM r2m),
scored AS (SELECT {KEYS}, band, f * (w11 * z1 + w12 * z2) AS t1, f * (r21 * z1 + r22 * z2) AS t2 FROM z, model),
q AS (SELECT band, share, sy, (c1 * w11 + c2 * w12) / tt1 AS q1, (c1 * r21 + c2 * r22) / tt2 AS q2 FROM cls, model)"""


BAND_PREDICTED = """qs AS (SELECT
  max(CASE WHEN band = 'high' THEN share END) AS ah, max(CASE WHEN band = 'high' THEN sy * q1 END) AS bh, max(CASE WHEN band = 'high' THEN sy * q2 END) AS ch,
  max(CASE WHEN band = 'low' THEN share END) AS al, max(CASE WHEN band = 'low' THEN sy * q1 END) AS bl, max(CASE WHEN band = 'low' THEN sy * q2 END) AS cl,
  max(CASE WHEN band = 'mid' THEN share END) AS am, max(CASE WHEN band = 'mid' THEN sy * q1 END) AS bm, max(CASE WHEN band = 'mid' THEN sy * q2 END) AS cm
  FROM q),
resp AS (SELECT scored.*, ah + bh * t1 + ch * t2 AS yh, al + bl * t1 + cl * t2 AS yl, am + bm * t1 + cm * t2 AS ym FROM scored, qs),
predicted AS (SELECT *, CASE WHEN yh >= yl AND yh >= ym THEN 'high' WHEN yl >= ym THEN 'low' ELSE 'mid' END AS prediction FROM resp)"""


def plsda_fit(scale: bool) -> str:
    return f"""WITH {banded(scale)}
SELECT 1 AS component, 'l_quantity' AS feature, {r("w11")} AS weight FROM model
UNION ALL SELECT 1, 'l_extendedprice', {r("w12")} FROM model
UNION ALL SELECT 2, 'l_quantity', {r("w21")} FROM model
UNION ALL SELECT 2, 'l_extendedprice', {r("w22")} FROM model"""


def plsda_top_weights() -> str:
    def ranked(a: int) -> str:
        return f"""SELECT row_number() OVER (ORDER BY round(abs(v), 10) DESC, o) AS rk, name, v FROM (
  SELECT 0 AS o, 'l_quantity' AS name, w{a}1 AS v FROM model UNION ALL SELECT 1, 'l_extendedprice', w{a}2 FROM model)"""

    return f"""WITH {banded()}, one AS ({ranked(1)}), two AS ({ranked(2)})
SELECT one.rk::INTEGER AS "rank", one.name AS lv1_feature, {r("one.v")} AS lv1_weight, two.name AS lv2_feature, {r("two.v")} AS lv2_weight
FROM one JOIN two ON one.rk = two.rk"""


def plsda_vip() -> str:
    def vip(j: int) -> str:
        return f"sqrt(2 * (w1{j} * w1{j} * tt1 + w2{j} * w2{j} * tt2) / (tt1 + tt2))"

    return f"""WITH {banded()}, v AS (SELECT 0 AS o, 'l_quantity' AS feature, {vip(1)} AS vip FROM model
  UNION ALL SELECT 1, 'l_extendedprice', {vip(2)} FROM model)
SELECT (row_number() OVER (ORDER BY round(vip, 10) DESC, o))::INTEGER AS "rank", feature, {r("vip")} AS vip FROM v"""


# Two classes, 64 features: weights of component a follow from the features' covariances
# with the class, deflated by the component before.
HALVED = """v AS (SELECT vec_id, CASE WHEN label < 5 THEN 'low' ELSE 'high' END AS half, embedding FROM embeddings),
total AS (SELECT count(*)::DOUBLE AS n, avg(CASE WHEN half = 'high' THEN 1.0 ELSE 0.0 END) AS share FROM v),
long AS (SELECT vec_id, half, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM v),
st AS (SELECT i, avg(x) AS m, stddev_samp(x) AS s FROM long GROUP BY i),
z AS (SELECT vec_id, half, i, (x - m) / s AS z, CASE WHEN half = 'high' THEN 1.0 ELSE 0.0 END - share AS y
  FROM long JOIN st USING (i), total),
c AS (SELECT i, sum(z * y) AS c FROM z GROUP BY i),
w1 AS (SELECT i, c, c / sqrt(sum(c * c) OVER ()) * sign(first_value(c) OVER (ORDER BY abs(c) DESC, i)) AS w FROM c),
t1 AS (SELECT vec_id, half, y, sum(z * w) AS t FROM z JOIN w1 USING (i) GROUP BY vec_id, half, y),
s1 AS (SELECT sum(t * t) AS tt, sum(t * y) AS ty FROM t1),
p1 AS (SELECT i, sum(z * t) / any_value(tt) AS p FROM z JOIN t1 USING (vec_id), s1 GROUP BY i),
d2 AS (SELECT i, w, p, c - p * ty AS c2 FROM w1 JOIN p1 USING (i), s1),
w2 AS (SELECT *, c2 / sqrt(sum(c2 * c2) OVER ()) * sign(first_value(c2) OVER (ORDER BY abs(c2) DESC, i)) AS ww FROM d2),
r2 AS (SELECT *, ww - sum(p * ww) OVER () * w AS rr FROM w2),
t2 AS (SELECT vec_id, half, y, sum(z * w) AS t, sum(z * rr) AS u FROM z JOIN r2 USING (i) GROUP BY vec_id, half, y),
s2 AS (SELECT sum(t * t) AS tt, sum(t * y) AS ty, sum(u * u) AS uu, sum(u * y) AS uy FROM t2)"""


def plsda_wide(tail: str) -> str:
    return f"WITH {HALVED}\n{tail}"


def plsda_top_weights_wide() -> str:
    def ranked(w: str) -> str:
        return f"SELECT row_number() OVER (ORDER BY round(abs({w}), 10) DESC, i) AS rk, 'e' || i AS name, {w} AS v FROM r2"

    return plsda_wide(f""", one AS ({ranked("w")}), two AS ({ranked("ww")})
SELECT one.rk::INTEGER AS "rank", one.name AS lv1_feature, {r("one.v")} AS lv1_weight, printf('%.3f', one.v) AS lv1_weight_text,
  two.name AS lv2_feature, {r("two.v")} AS lv2_weight, printf('%.3f', two.v) AS lv2_weight_text
FROM one JOIN two ON one.rk = two.rk WHERE one.rk <= 10""")


def plsda_vip_wide() -> str:
    return plsda_wide(f""", imp AS (SELECT i, sqrt(64 * (w * w * tt + ww * ww * uu) / (tt + uu)) AS vip FROM r2, s2),
places AS (SELECT row_number() OVER (ORDER BY round(vip, 10) DESC, i) AS rk, * FROM imp)
SELECT rk::INTEGER AS "rank", 'e' || i AS feature, {r("vip")} AS vip, printf('%.3f', vip) AS vip_text FROM places WHERE rk <= 10""")


def metrics_unlabelled() -> str:
    texts = TEXTS.replace("USING (doc_id))", "USING (doc_id) WHERE doc_id % 4 <> 0)", 1)
    points = f"""pts AS (SELECT doc_id, quality, t1, t2 FROM fitted WHERE mask = {FULL}),
cm AS (SELECT label, prediction, n FROM counts WHERE mask = {FULL})"""
    f1, hits = r(f1_of("cm")), r("hits / acc.n")
    ratio = r("CASE WHEN within > 1e-6 THEN between_ / within END")
    return f"""WITH {texts}, {MODELS}, {points}, {fisher_of("pts", "t1", "t2", "quality")}
SELECT 'accuracy' AS measure, {hits} AS value FROM acc WHERE mask = {FULL}
UNION ALL SELECT 'accuracy_of_selection', {hits} FROM acc WHERE mask = {FULL}
UNION ALL SELECT 'macro_f1', {f1} UNION ALL SELECT 'f1_of_selection', {f1}
UNION ALL SELECT 'fisher_of_model', {ratio} FROM fisher UNION ALL SELECT 'fisher_of_scores', {ratio} FROM fisher"""


def plsda_variance() -> str:
    return f"""WITH {banded()}
SELECT 1 AS component, {r("tt1 / n")} AS score_variance, {r("tt1 / n / 2 * 100")} AS percent FROM model
UNION ALL SELECT 2, {r("tt2 / n")}, {r("tt2 / n / 2 * 100")} FROM model"""


def confusion(tail: str) -> str:
    return f"""WITH {banded()}, {BAND_PREDICTED},
cm AS (SELECT band AS label, prediction, count(*) AS n FROM predicted GROUP BY band, prediction)
{tail}"""


def f1_of(counts: str) -> str:
    """Macro F1 from label, prediction, n."""
    return f"""(SELECT avg(CASE WHEN tp + tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END) FROM (
  SELECT k, sum(CASE WHEN label = k AND prediction = k THEN n ELSE 0 END) AS tp,
    sum(CASE WHEN label <> k AND prediction = k THEN n ELSE 0 END) AS fp,
    sum(CASE WHEN label = k AND prediction <> k THEN n ELSE 0 END) AS fn
  FROM {counts}, (SELECT label AS k FROM {counts} UNION SELECT prediction FROM {counts}) GROUP BY k))"""


def fisher_of(source: str, x: str, y: str, label: str) -> str:
    """CTE fisher(between, within)."""
    return f"""fisher AS (SELECT sum(n * (power(mx - ox, 2) + power(my - oy, 2))) AS between_, sum(n * (vx + vy)) AS within
  FROM (SELECT {label}, count(*) AS n, avg({x}) AS mx, avg({y}) AS my, var_pop({x}) AS vx, var_pop({y}) AS vy
    FROM {source} GROUP BY {label}), (SELECT avg({x}) AS ox, avg({y}) AS oy FROM {source}))"""


def silhouette_of(source: str, key: str, x: str, y: str, label: str) -> str:
    """CTE sil(silhouette, n_rows, n_classes): every pair of points compared."""
    return f"""sizes AS (SELECT {label} AS k, count(*) AS nk FROM {source} GROUP BY {label}),
sums AS (SELECT a.{key} AS id, a.{label} AS own, b.{label} AS k,
    sum(sqrt(power(a.{x} - b.{x}, 2) + power(a.{y} - b.{y}, 2))) AS d
  FROM {source} a CROSS JOIN {source} b GROUP BY a.{key}, a.{label}, b.{label}),
means AS (SELECT id, own, max(CASE WHEN k = own AND nk > 1 THEN d / (nk - 1) END) AS a,
    min(CASE WHEN k <> own THEN d / nk END) AS b FROM sums JOIN sizes USING (k) GROUP BY id, own),
sil AS (SELECT avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette,
    count(*) AS n_rows, (SELECT count(*) FROM sizes) AS n_classes FROM means)"""


# --- PLS of any features, two classes ------------------------------------------------


def count_of(characters: str) -> str:
    return f"(length(text) - length(translate(text, '{characters}', '')))::DOUBLE"


TEXTS = f"""texts AS (
  SELECT doc_id, CAST(quality AS VARCHAR) AS quality, [length(text)::DOUBLE, {count_of(' ')}, {count_of(DIGITS)},
    {count_of(CAPITALS)}, {count_of(MARKS)}] AS f
  FROM documents JOIN labels USING (doc_id)),
long AS (SELECT doc_id, quality, unnest(f) AS x, unnest(range({len(TEXT_FEATURES)})) AS i FROM texts),
st AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY i),
z AS (SELECT doc_id, quality, long.i, (x - m) / s AS z FROM long JOIN st ON long.i = st.i),
names AS (SELECT unnest({list(TEXT_FEATURES)}) AS name, unnest(range({len(TEXT_FEATURES)})) AS i)"""

FULL = 2 ** len(TEXT_FEATURES) - 1

# One model for each set of features, given as the bits of a number.
MODELS = f"""total AS (SELECT count(*)::DOUBLE AS n, avg(CASE WHEN quality = '1' THEN 1.0 ELSE 0.0 END) AS share FROM texts),
g AS (SELECT a.i AS i, b.i AS j, sum(a.z * b.z) AS g FROM z a JOIN z b ON a.doc_id = b.doc_id GROUP BY a.i, b.i),
c AS (SELECT i, sum(CASE WHEN quality = '1' THEN z ELSE 0 END) AS c FROM z GROUP BY i),
sets AS (SELECT mask, i FROM (SELECT unnest(range(1, {FULL + 1})) AS mask), names
  WHERE (mask >> i) & 1 = 1 AND bit_count(mask) >= 2),
w1 AS (SELECT mask, i, c / sqrt(sum(c * c) OVER m)
    * sign(first_value(c) OVER (PARTITION BY mask ORDER BY abs(c) DESC, i)) AS w, c
  FROM sets JOIN c USING (i) WINDOW m AS (PARTITION BY mask)),
u1 AS (SELECT w1.mask, g.i, sum(g.g * w1.w) AS u FROM w1 JOIN g ON g.j = w1.i
  JOIN sets ON sets.mask = w1.mask AND sets.i = g.i GROUP BY w1.mask, g.i),
one AS (SELECT mask, i, w, c, u, sum(w * u) OVER m AS tt, sum(c * w) OVER m AS cw
  FROM w1 JOIN u1 USING (mask, i) WINDOW m AS (PARTITION BY mask)),
v2 AS (SELECT mask, i, w, c, tt, cw, u / tt AS p, c - u / tt * cw AS v FROM one),
w2 AS (SELECT *, v / sqrt(sum(v * v) OVER m) * sign(first_value(v) OVER (PARTITION BY mask ORDER BY abs(v) DESC, i)) AS ww
  FROM v2 WINDOW m AS (PARTITION BY mask)),
r2 AS (SELECT *, ww - sum(p * ww) OVER m * w AS rr FROM w2 WINDOW m AS (PARTITION BY mask)),
u2 AS (SELECT r2.mask, g.i, sum(g.g * r2.rr) AS u FROM r2 JOIN g ON g.j = r2.i
  JOIN sets ON sets.mask = r2.mask AND sets.i = g.i GROUP BY r2.mask, g.i),
two AS (SELECT r2.*, sum(rr * u) OVER m AS tt2, sum(c * rr) OVER m AS cr
  FROM r2 JOIN u2 USING (mask, i) WINDOW m AS (PARTITION BY mask)),
coef AS (SELECT mask, i, w, rr, w * cw / tt + rr * cr / tt2 AS b FROM two),
fitted AS (SELECT mask, doc_id, quality, sum(z * w) AS t1, sum(z * rr) AS t2,
    CASE WHEN share + sum(z * b) > 1 - (share + sum(z * b)) THEN '1' ELSE '0' END AS prediction
  FROM z JOIN coef USING (i), total GROUP BY mask, doc_id, quality, share),
counts AS (SELECT mask, quality AS label, prediction, count(*) AS n FROM fitted GROUP BY mask, quality, prediction),
acc AS (SELECT mask, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hits, sum(n) AS n FROM counts GROUP BY mask)"""

GREEDY = f"""grow AS (SELECT * FROM (SELECT a.mask, names.i, name, b.mask AS next, b.hits,
    row_number() OVER (PARTITION BY a.mask ORDER BY b.hits DESC, names.i) AS rk
  FROM acc a, names JOIN acc b ON true WHERE (a.mask >> names.i) & 1 = 0 AND b.mask = a.mask | (1 << names.i)) WHERE rk = 1),
shrink AS (SELECT * FROM (SELECT a.mask, names.i, name, b.mask AS next, b.hits,
    row_number() OVER (PARTITION BY a.mask ORDER BY b.hits DESC, names.i) AS rk
  FROM acc a, names JOIN acc b ON true WHERE (a.mask >> names.i) & 1 = 1 AND b.mask = a.mask - (1 << names.i)) WHERE rk = 1),
fwd AS (
  SELECT 1 AS step, mask, hits, 0 AS flat, 'n_digits,n_marks' AS added FROM acc WHERE mask = (1 << 2) | (1 << 4)
  UNION ALL
  SELECT step + 1, next, grow.hits, CASE WHEN grow.hits = fwd.hits THEN flat + 1 ELSE 0 END, name
  FROM fwd JOIN grow ON grow.mask = fwd.mask WHERE grow.hits >= fwd.hits AND flat < 10),
bwd AS (
  SELECT 0 AS step, mask, hits, '' AS removed FROM acc WHERE mask = {FULL}
  UNION ALL
  SELECT step + 1, next, shrink.hits, name
  FROM bwd JOIN shrink ON shrink.mask = bwd.mask WHERE shrink.hits >= bwd.hits AND bit_count(bwd.mask) > 2)"""

SELECTION = f"WITH RECURSIVE {TEXTS}, {MODELS}, {GREEDY}"


def metrics_table() -> str:
    scaled = f"""pts AS (SELECT doc_id, quality, prediction, t1 * sqrt((n - 1) / n) AS t1, t2 * sqrt((n - 1) / n) AS t2
  FROM fitted, total WHERE mask = {FULL}),
cm AS (SELECT label, prediction, n FROM counts WHERE mask = {FULL})"""
    return f"""WITH {TEXTS}, {MODELS}, {scaled}, {fisher_of("pts", "t1", "t2", "quality")},
{silhouette_of("pts", "doc_id", "t1", "t2", "quality")}
, measured AS (
SELECT 0 AS ord, 'Accuracy' AS metric, hits / acc.n AS v FROM acc WHERE mask = {FULL}
UNION ALL SELECT 1, 'F1 Score', {f1_of("cm")}
UNION ALL SELECT 2, 'Silhouette', silhouette FROM sil
UNION ALL SELECT 3, 'Fisher Ratio', CASE WHEN within > 1e-6 THEN between_ / within END FROM fisher)
SELECT ord, metric, {r("v")} AS value, coalesce(printf('%.3f', v), 'N/A') AS value_text FROM measured"""


def evaluate_subset() -> str:
    prefixes = [2**n - 1 for n in range(2, len(TEXT_FEATURES) + 1)]
    parts = []
    for mask in prefixes:
        parts.append(
            f"SELECT 'accuracy' AS scoring, {bin(mask).count('1')} AS n_features, {r('hits / n')} AS score FROM acc WHERE mask = {mask}"
        )
        counts = f"(SELECT label, prediction, n FROM counts WHERE mask = {mask})"
        parts.append(f"SELECT 'f1', {bin(mask).count('1')}, {r(f1_of(counts))}")
    return f"WITH {TEXTS}, {MODELS}\n" + union_all(parts)


def sweep_add_one() -> str:
    return f"""WITH {TEXTS}, {MODELS}
SELECT name AS candidate, 3 AS n_features, {r("hits / n")} AS score
FROM names JOIN acc ON mask = (1 << 2) | (1 << 4) | (1 << i) WHERE i NOT IN (2, 4)"""


def sweep_drop_one() -> str:
    return f"""WITH {TEXTS}, {MODELS}
SELECT name AS candidate, {len(TEXT_FEATURES) - 1} AS n_features, {r("hits / n")} AS score
FROM names JOIN acc ON mask = {FULL} - (1 << i)"""


ACCURACY = r("hits / (SELECT n FROM total)")
FORWARD_MASK = "(SELECT mask FROM fwd WHERE step = (SELECT min(step) FROM fwd WHERE bit_count(mask) = 3))"
BACKWARD_MASK = "(SELECT arg_min(mask, step) FROM bwd WHERE bit_count(mask) = greatest(3, (SELECT min(bit_count(mask)) FROM bwd)))"


def scores_at(mask: str) -> str:
    return f"""{SELECTION}
SELECT doc_id, quality, {r("t1", 5)} AS LV1, {r("t2", 5)} AS LV2 FROM fitted WHERE mask = {mask}"""


# --- all -----------------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    narrow = ", ".join(LINE_FEATURES)
    dirty_kept = [c for c in DIRTY_FEATURES if c not in ("d_gaps", "d_empty")]
    return {
        "scan_samples": f"SELECT {KEYS}, l_returnflag, {narrow} FROM lineitem",
        "scan_entities": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part",
        "scan_pairs": "SELECT c_name AS formula, c_mktsegment AS structure FROM customer",
        "catalog_group_sizes": """SELECT 'size' AS group_id, 0 AS group_ord, 2::BIGINT AS n_features, 2::BIGINT AS n_available,
  count(l_quantity) + count(l_extendedprice) AS n_values FROM lineitem
UNION ALL SELECT 'rates', 1, 3, 2, count(l_discount) + count(l_tax) FROM lineitem
UNION ALL SELECT 'mixed', 2, 2, 2, count(l_extendedprice) + count(l_tax) FROM lineitem""",
        "select_feature_group": f"SELECT {KEYS}, l_quantity, l_discount, l_tax FROM lineitem",
        "column_profile": column_profile(),
        "drop_nan_columns": f"WITH {DIRTY} SELECT {KEYS}, {', '.join(dirty_kept)} FROM dirty",
        "drop_zero_variance": f"WITH {DIRTY} SELECT {KEYS}, {', '.join(c for c in DIRTY_FEATURES if c != 'd_const')} FROM dirty",
        "clean_values": f"WITH {DIRTY} SELECT {KEYS}, {', '.join(clean(c) for c in DIRTY_FEATURES)} FROM dirty",
        "standardize": standardize("lineitem", LINE_FEATURES, False),
        "standardize_impute": standardize("dirty", DIRTY_FEATURES, True),
        "category_lookup": category_lookup(),
        "invert_categories": """WITH cat AS (SELECT p_type, min(p_partkey) AS ord FROM part GROUP BY p_type),
listed AS (SELECT DISTINCT p_brand, p_type FROM part)
SELECT p_brand AS symbol, arg_max(p_type, ord) AS category FROM listed JOIN cat USING (p_type) GROUP BY p_brand""",
        "split_formula": f"""WITH {PAIRS}, t AS (SELECT formula, structure, regexp_extract_all(formula, '[A-Z][a-z]?') AS tokens FROM pairs)
SELECT formula, structure, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, ' ') AS symbols FROM t""",
        "text_symbols": """SELECT symbol, count(*) AS n FROM
(SELECT unnest(regexp_extract_all(text, '[A-Z][a-z]?')) AS symbol FROM documents) GROUP BY symbol""",
        "pair_rejects": """SELECT doc_id, n_tokens FROM
(SELECT doc_id, len(regexp_extract_all(text, '[A-Z][a-z]?'))::INTEGER AS n_tokens FROM documents) WHERE n_tokens <> 2""",
        "pair_links": pair_links(),
        "pair_link_counts": pair_link_counts(),
        "class_dictionary": """SELECT (row_number() OVER (ORDER BY label) - 1)::INTEGER AS class_index, label
FROM (SELECT DISTINCT event_type AS label FROM events WHERE event_type IS NOT NULL)""",
        "one_hot": "SELECT o_orderkey, "
        + ", ".join(f"(o_orderstatus = '{s}')::DOUBLE AS \"is_{s}\"" for s in ("F", "O", "P"))
        + " FROM orders",
        "correlation_matrix": correlation_matrix(),
        "correlation_merged": correlation_matrix(),
        "feature_guard": f"""WITH {TEXTS}, sizes AS (SELECT unnest([0, 1, 2]) AS size),
usable AS (SELECT size, (SELECT count(*) FROM st WHERE st.i < size AND st.s > 0) AS n FROM sizes)
SELECT size::INTEGER AS n_features, n::INTEGER AS n_usable, (CASE WHEN n >= 2 THEN 2 ELSE 0 END)::INTEGER AS n_components,
  n < 2 AS refused FROM usable""",
        "pca_of_feature_pairs": f"""WITH {VECTOR_Z}, n AS (SELECT count(DISTINCT vec_id) AS n FROM z),
corr AS (SELECT a.i, b.i AS j, abs(sum(a.z * b.z) / (SELECT n FROM n)) AS c FROM z a JOIN z b ON a.vec_id = b.vec_id AND a.i < b.i
  GROUP BY a.i, b.i)
SELECT (i * 64 + j)::BIGINT AS subset_id, 2 AS n_features, {r("50 * (1 + c)")} AS pc1_percent, {r("50 * (1 - c)")} AS pc2_percent FROM corr""",
        "correlation_matrix_wide": f"""WITH {VECTOR_Z}
SELECT 'e' || a.i AS feature_i, 'e' || b.i AS feature_j, {r("avg(a.z * b.z)")} AS correlation
FROM z a JOIN z b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""",
        "class_feature_sums": class_feature_sums(),
        "class_feature_sums_merged": class_feature_sums(),
        "class_feature_sums_wide": f"""WITH {VECTOR_Z}
SELECT label, count(*) AS n_rows, 'e' || i AS feature, {r("sum(z)")} AS z_sum FROM z GROUP BY label, i""",
        "pca_fit": pca_fit(),
        "pca_scores": f"WITH {pca2(*SIZE)}\n{pca_scores(*SIZE, KEYS, 5)}",
        "pca_explained_variance": f"""WITH {pca2(*SIZE)}
SELECT 1 AS component, {r("1 + abs(c)")} AS eigenvalue, {r("(1 + abs(c)) / 2 * 100")} AS percent,
  printf('%.1f%%', (1 + abs(c)) / 2 * 100) AS percent_text FROM model
UNION ALL SELECT 2, {r("1 - abs(c)")}, {r("(1 - abs(c)) / 2 * 100")}, printf('%.1f%%', (1 - abs(c)) / 2 * 100) FROM model""",
        "pca_top_loadings": pca_top_loadings(),
        "pca_by_feature_group": pca_by_feature_group(),
        "plsda_fit": plsda_fit(True),
        "plsda_fit_unscaled": plsda_fit(False),
        "plsda_scores": f"WITH {banded()} SELECT {KEYS}, band, {r('t1', 5)} AS LV1, {r('t2', 5)} AS LV2 FROM scored",
        "plsda_variance": plsda_variance(),
        "plsda_predict_gaps": f"WITH {banded()}, {BAND_PREDICTED} SELECT {KEYS}, band,"
        " CASE WHEN l_linenumber NOT IN (1, 2, 3) THEN prediction END AS prediction FROM predicted",
        "plsda_scores_wide": plsda_wide(f"SELECT vec_id, half, {r('t', 5)} AS LV1, {r('u', 5)} AS LV2 FROM t2"),
        "plsda_predict_wide": plsda_wide(
            "SELECT vec_id, half, CASE WHEN 2 * (share + t * ty / tt + u * uy / uu) >= 1 THEN 'high' ELSE 'low' END AS prediction"
            " FROM t2, s2, total"
        ),
        "plsda_top_weights_wide": plsda_top_weights_wide(),
        "plsda_vip_wide": plsda_vip_wide(),
        "plsda_predict": f"WITH {banded()}, {BAND_PREDICTED} SELECT {KEYS}, band, prediction FROM predicted",
        "plsda_top_weights": plsda_top_weights(),
        "plsda_vip": plsda_vip(),
        "confusion_matrix": confusion("SELECT * FROM cm"),
        "accuracy": confusion(
            f"SELECT {r('sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n)')} AS accuracy FROM cm"
        ),
        "macro_f1": confusion(f"SELECT {r(f1_of('cm'))} AS macro_f1"),
        "silhouette_exact": f"""WITH pts AS (SELECT vec_id, CAST(label AS VARCHAR) AS label, embedding[1]::DOUBLE AS x,
    embedding[2]::DOUBLE AS y FROM embeddings), {silhouette_of("pts", "vec_id", "x", "y", "label")}
SELECT n_rows, n_classes::INTEGER AS n_classes, {r("silhouette")} AS silhouette FROM sil""",
        "silhouette_orders": f"""WITH pts AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000 AS x, o_custkey::DOUBLE AS y FROM orders),
{silhouette_of("pts", "o_orderkey", "x", "y", "o_orderstatus")}
SELECT n_rows, n_classes::INTEGER AS n_classes, {r("silhouette")} AS silhouette FROM sil""",
        "silhouette_adaptive_orders": f"""WITH pts AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000 AS x, o_custkey::DOUBLE AS y FROM orders),
{silhouette_of("pts", "o_orderkey", "x", "y", "o_orderstatus")}
SELECT n_rows, n_classes::INTEGER AS n_classes, {r("silhouette")} AS silhouette FROM sil""",
        "fisher_ratio": f"""WITH {banded()}, {fisher_of("scored", "t1", "t2", "band")}
SELECT {r("between_", 5)} AS "between", {r("within", 5)} AS within, {r("CASE WHEN within > 1e-6 THEN between_ / within END", 5)} AS fisher_ratio FROM fisher""",
        "catalog_on_vectors": catalog_on_vectors(),
        "metrics_table": metrics_table(),
        "metrics_unlabelled": metrics_unlabelled(),
        "evaluate_subset": evaluate_subset(),
        "sweep_add_one": sweep_add_one(),
        "sweep_drop_one": sweep_drop_one(),
        "forward_selection": f"""{SELECTION}
SELECT step, {ACCURACY} AS accuracy, added AS feature_added, bit_count(mask)::INTEGER AS total_features FROM fwd""",
        "backward_elimination": f"""{SELECTION}
SELECT step, {ACCURACY} AS accuracy, removed AS feature_removed, bit_count(mask)::INTEGER AS total_features FROM bwd""",
        "replay_forward": f"""{SELECTION}, upto AS (SELECT step, string_split(added, ',') AS f FROM fwd
  WHERE step <= (SELECT min(step) FROM fwd WHERE bit_count(mask) = 3))
SELECT step, unnest(range(len(f)))::INTEGER AS pos, unnest(f) AS feature FROM upto""",
        "replay_forward_every": f"""{SELECTION}, every_size AS (SELECT step, bit_count(mask)::INTEGER AS total_features,
  array_to_string(flatten(list(string_split(added, ',')) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), ',') AS features
  FROM fwd)
SELECT step, total_features, features FROM every_size QUALIFY row_number() OVER (PARTITION BY total_features ORDER BY step) = 1""",
        "replay_backward": f"{SELECTION} SELECT i::INTEGER AS ord, name AS feature FROM names WHERE ({BACKWARD_MASK} >> i) & 1 = 1",
        "final_features": f"""{SELECTION}, kept AS (SELECT i, name FROM names
  WHERE ((SELECT arg_max(mask, step) FROM bwd) >> i) & 1 = 1)
SELECT count(*) AS n_features, string_agg(name, ', ' ORDER BY i) AS features,
  'Final ' || count(*) || ' features: ' || string_agg(name, ', ' ORDER BY i) AS summary FROM kept""",
        "scores_at_step": scores_at(FORWARD_MASK),
        "scores_at_backward_step": scores_at(BACKWARD_MASK),
        "selection_curve": f"""{SELECTION}
SELECT step, bit_count(mask)::INTEGER AS total_features, {ACCURACY} AS accuracy,
  ((SELECT min(bit_count(mask)) FROM fwd) - 1)::INTEGER AS axis_low, ((SELECT max(bit_count(mask)) FROM fwd) + 1)::INTEGER AS axis_high FROM fwd""",
        "safe_division": f"""SELECT {KEYS}, {r("CASE WHEN l_discount = 0 THEN -1.0 ELSE l_tax / l_discount END")} AS ratio FROM lineitem""",
    }
