"""Feature-table statistics, sampling and feature scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiframe.operators import features as ft
from lexiframe.operators import sampling as sm
from lexiframe.operators import selection as sl
from lexiframe.operators.ranking import exact_quantiles
from lexiframe.queries import register
from lexiframe.queries.inputs import rnd, rounded
from lexiframe.sources.readers import read_table, spread

DIMS = 64
COLS = [f"f{i:02d}" for i in range(DIMS)]
ITEM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

FLAT = """flat AS (SELECT vec_id, label, 'f' || lpad(CAST(i AS VARCHAR), 2, '0') AS feature, v::DOUBLE AS value FROM
    (SELECT vec_id, label, unnest(range(64)) AS i, unnest(embedding) AS v FROM embeddings))"""
ITEMS = f"""items AS (UNPIVOT (SELECT l_orderkey, l_linenumber, {', '.join(ITEM_COLS)} FROM lineitem)
    ON {', '.join(ITEM_COLS)} INTO NAME feature VALUE value)"""


def embeddings(spark, folder):
    return spread(read_table(spark, folder, "embeddings"), "vec_id")


def table(spark, folder):
    """Labelled feature table with 64 double columns."""
    return ft.wide(embeddings(spark, folder), "embedding", DIMS, ["vec_id", "label"])


def vectors(spark, folder):
    return embeddings(spark, folder).select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vector")
    )


def items(spark, folder):
    rows = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *ITEM_COLS)
    return spread(rows, "l_orderkey")


def long_rounded(df, keep, cols):
    return ft.unpivot(df, keep, cols).withColumn("value", rounded(F.col("value")))


@register("i01_label_histogram", "SELECT label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY label")
def label_histogram(spark, folder):
    return ft.label_histogram(embeddings(spark, folder), "label", by_count=True)


@register(
    "i02_quantiles",
    f"""WITH {ITEMS}, {FLAT} SELECT feature, {rnd('quantile_cont(value, 0.25)')} AS q1, {rnd('quantile_cont(value, 0.75)')} AS q3
        FROM (SELECT feature, value FROM items UNION ALL SELECT feature, value FROM flat) GROUP BY feature""",
)
def quantiles(spark, folder):
    found = exact_quantiles(items(spark, folder), ITEM_COLS, [0.25, 0.75])
    found |= exact_quantiles(table(spark, folder), COLS, [0.25, 0.75])
    rows = [(c, round(a, 6), round(b, 6)) for c, (a, b) in found.items()]
    return spark.createDataFrame(rows, "feature string, q1 double, q3 double")


@register(
    "i03_winsorize",
    f"""WITH {FLAT}, q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM flat GROUP BY feature),
        b AS (SELECT feature, q1 - 0.5 * (q3 - q1) AS lo, q3 + 0.5 * (q3 - q1) AS hi FROM q)
        SELECT vec_id, feature, {rnd('CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END')} AS value
        FROM flat JOIN b USING (feature)""",
)
def winsorize(spark, folder):
    """A narrow factor, so that many values are clipped."""
    rows = table(spark, folder)
    return long_rounded(ft.winsorize(rows, ft.fit_outlier_bounds(rows, COLS, factor=0.5)), ["vec_id"], COLS)


@register(
    "i04_variance_ranking",
    f"WITH {FLAT} SELECT feature, {rnd('var_samp(value)')} AS value FROM flat GROUP BY feature ORDER BY var_samp(value) DESC LIMIT 10",
)
def variance_ranking(spark, folder):
    top = ft.rank_by_variance(table(spark, folder), COLS).limit(10)
    return top.withColumn("value", rounded(F.col("value")))


@register(
    "i05_interactions",
    f"""WITH {FLAT}, top AS (SELECT feature, row_number() OVER (ORDER BY var_samp(value) DESC, feature) AS r FROM flat GROUP BY feature),
        f AS (SELECT vec_id, flat.feature, value, r FROM flat JOIN top ON flat.feature = top.feature WHERE r <= 10)
        SELECT a.vec_id, a.feature || '_x_' || b.feature AS feature, {rnd('a.value * b.value')} AS value
        FROM f a JOIN f b ON a.vec_id = b.vec_id AND a.r < b.r""",
)
def interactions(spark, folder):
    rows = table(spark, folder)
    pairs = ft.interaction_names(rows, COLS)
    return long_rounded(ft.with_interactions(rows, pairs), ["vec_id"], [f"{a}_x_{b}" for a, b in pairs])


SCALED = f"""WITH {FLAT}, s AS (SELECT feature, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd
    FROM flat GROUP BY feature)"""


@register("i06_standardize", f"{SCALED} SELECT vec_id, feature, {rnd('(value - m) / sd')} AS value FROM flat JOIN s USING (feature)")
def standardize(spark, folder):
    rows = table(spark, folder)
    return long_rounded(ft.rescale(rows, ft.fit_standard(rows, COLS)), ["vec_id"], COLS)


@register(
    "i07_robust_scale",
    f"""WITH {FLAT}, s AS (SELECT feature, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS d
        FROM flat GROUP BY feature) SELECT vec_id, feature, {rnd('(value - m) / CASE WHEN d = 0 THEN 1 ELSE d END')} AS value
        FROM flat JOIN s USING (feature)""",
)
def robust_scale(spark, folder):
    rows = table(spark, folder)
    return long_rounded(ft.rescale(rows, ft.fit_robust(rows, COLS)), ["vec_id"], COLS)


@register(
    "i08_clip",
    f"""{SCALED} SELECT vec_id, feature, {rnd('greatest(-5, least(5, (value - m) / sd))')} AS value,
        {rnd('greatest(-1, least(1, (value - m) / sd))')} AS narrow FROM flat JOIN s USING (feature)""",
)
def clip(spark, folder):
    rows = table(spark, folder)
    scaled = ft.rescale(rows, ft.fit_standard(rows, COLS))
    wide = ft.unpivot(ft.clip_columns(scaled, COLS, 5.0), ["vec_id"], COLS)
    return wide.select(
        "vec_id", "feature", rounded(F.col("value")).alias("value"), rounded(ft.clipped(F.col("value"), -1.0, 1.0)).alias("narrow")
    )


# ---- splits in SQL -----------------------------------------------------------------------------------------


def quota_sql(source: str, size: str, fraction: str, name: str, out: str) -> str:
    return f"""{out}_x AS (SELECT *, ceil({fraction} * sum({size}) OVER ())::DOUBLE * {size} / sum({size}) OVER () AS ex,
            ceil({fraction} * sum({size}) OVER ()) AS tgt FROM {source}),
        {out} AS (SELECT * EXCLUDE (ex, tgt), floor(ex)::BIGINT + CASE WHEN row_number() OVER (ORDER BY ex - floor(ex) DESC, label)
            <= tgt - sum(floor(ex)) OVER () THEN 1 ELSE 0 END AS {name} FROM {out}_x)"""


SPLIT_SQL = f"""ranked AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id)) AS r FROM embeddings),
    cls AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
    {quota_sql('cls', 'n', '0.15::DOUBLE', 'n_test', 'qt')},
    rest AS (SELECT *, n - n_test AS n_rest FROM qt),
    {quota_sql('rest', 'n_rest', '(0.15::DOUBLE / (1 - 0.15::DOUBLE))', 'n_val', 'qv')},
    split AS (SELECT vec_id, ranked.label, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split
              FROM ranked JOIN qv ON ranked.label = qv.label)"""


@register(
    "i09_fit_on_train",
    f"""WITH {FLAT}, {SPLIT_SQL}, s AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS sd
            FROM flat JOIN split USING (vec_id) WHERE split = 'train' GROUP BY feature)
        SELECT vec_id, split, feature, {rnd('(value - m) / sd')} AS value FROM flat JOIN split USING (vec_id) JOIN s USING (feature)""",
)
def fit_on_train(spark, folder):
    rows = split_table(spark, folder)
    fitted = ft.fit_standard(rows.filter(F.col("split") == "train"), COLS)
    return long_rounded(ft.rescale(rows, fitted), ["vec_id", "split"], COLS)


def split_table(spark, folder):
    return sm.stratified_split(table(spark, folder), "label", "vec_id", 0.15, 0.15)


@register(
    "j01_stratified_split",
    f"WITH {SPLIT_SQL} SELECT vec_id, label, CASE WHEN split = 'test' THEN 'test' ELSE 'train' END AS split FROM split",
)
def stratified_split(spark, folder):
    return sm.stratified_split(embeddings(spark, folder).select("vec_id", "label"), "label", "vec_id", 0.15)


@register("j02_two_step_split", f"WITH {SPLIT_SQL} SELECT vec_id, label, split FROM split")
def two_step_split(spark, folder):
    return sm.stratified_split(embeddings(spark, folder).select("vec_id", "label"), "label", "vec_id", 0.15, 0.15)


@register(
    "j03_stratified_folds",
    """WITH ranked AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id)) AS r,
                              count(*) OVER (PARTITION BY label) AS n FROM embeddings)
       SELECT vec_id, label, CAST((CASE WHEN r > ceil(n / 5) THEN 1 ELSE 0 END) + (CASE WHEN r > ceil(2 * n / 5) THEN 1 ELSE 0 END)
            + (CASE WHEN r > ceil(3 * n / 5) THEN 1 ELSE 0 END) + (CASE WHEN r > ceil(4 * n / 5) THEN 1 ELSE 0 END) AS INTEGER) AS fold
       FROM ranked""",
)
def stratified_folds(spark, folder):
    return sm.stratified_folds(embeddings(spark, folder).select("vec_id", "label"), "label", "vec_id")


HEX = "(('0x' || substring(md5({t}), {at}, 8))::BIGINT{more})"
SMOTE_TEXT = "'42:' || b.vec_id || ':' || b.copy"


@register(
    "j04_oversample",
    f"""WITH cls AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS top FROM embeddings GROUP BY label),
        ranked AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id)) AS r FROM embeddings),
        base AS (SELECT vec_id, label, unnest(range(1, 1 + (top - n) // n + CASE WHEN r <= (top - n) % n THEN 1 ELSE 0 END)) AS copy
                 FROM ranked JOIN cls USING (label) WHERE top > n),
        {FLAT},
        pair AS (SELECT a.vec_id AS id, b.vec_id AS nb, round(sqrt(sum((a.value - b.value) * (a.value - b.value))), 6) AS d
                 FROM flat a JOIN flat b ON a.label = b.label AND a.feature = b.feature AND a.vec_id <> b.vec_id
                 WHERE a.vec_id IN (SELECT vec_id FROM base) GROUP BY a.vec_id, b.vec_id),
        near AS (SELECT id, nb, r, count(*) OVER (PARTITION BY id) AS k FROM (SELECT id, nb, row_number() OVER (PARTITION BY id ORDER BY d, nb) AS r
                 FROM pair) WHERE r <= 3),
        drawn AS (SELECT b.vec_id AS source, b.copy, b.label, near.nb AS neighbour,
                         ({HEX.format(t=SMOTE_TEXT, at=9, more='')} + 0.5::DOUBLE) / 4294967296::DOUBLE AS u
                  FROM base b JOIN near ON near.id = b.vec_id AND near.r = 1 + {HEX.format(t=SMOTE_TEXT, at=1, more='')} % near.k)
        SELECT 'original' AS kind, vec_id AS source, 0::BIGINT AS copy, label, vec_id AS neighbour, feature, {rnd('value')} AS value FROM flat
        UNION ALL SELECT 'synthetic', source, copy, d.label, neighbour, x.feature, {rnd('x.value + u * (y.value - x.value)')}
        FROM drawn d JOIN flat x ON x.vec_id = d.source JOIN flat y ON y.vec_id = d.neighbour AND y.feature = x.feature""",
)
def oversample(spark, folder):
    rows = vectors(spark, folder)
    new = sm.oversample(rows, digits=6).withColumn("kind", F.lit("synthetic"))
    old = rows.select(
        F.col("id").alias("source"), F.lit(0).cast("bigint").alias("copy"), "label", F.col("id").alias("neighbour"), "vector",
        F.lit("original").alias("kind"),
    )
    both = old.unionByName(new.drop("u"))
    flat = both.select("kind", "source", "copy", "label", "neighbour", F.posexplode("vector").alias("i", "value"))
    name = F.concat(F.lit("f"), F.lpad(F.col("i").cast("string"), 2, "0"))
    return flat.select("kind", "source", "copy", "label", "neighbour", name.alias("feature"), rounded(F.col("value")).alias("value"))


NOISE_TEXT = "'42:' || vec_id || ':' || feature"


def hex_unit(text: str, at: int) -> str:
    return f"(({HEX.format(t=text, at=at, more='')} + 0.5::DOUBLE) / 4294967296::DOUBLE)"


@register(
    "j05_noise",
    f"""WITH {FLAT}, {SPLIT_SQL} SELECT vec_id, split, feature, {rnd(f'''value + 0.1::DOUBLE * sqrt(-2 * ln({hex_unit(NOISE_TEXT, 1)}))
            * cos(2 * pi() * {hex_unit(NOISE_TEXT, 9)})''')} AS value FROM flat JOIN split USING (vec_id) WHERE split <> 'train'""",
)
def noise(spark, folder):
    held_out = split_table(spark, folder).filter(F.col("split") != "train")
    return long_rounded(sm.with_noise(held_out, COLS, "vec_id"), ["vec_id", "split"], COLS)


@register(
    "j06_class_weights",
    f"""SELECT vec_id, label, {rnd('(count(*) OVER ())::DOUBLE / ((SELECT count(DISTINCT label) FROM embeddings) * count(*) OVER (PARTITION BY label))')}
        AS weight FROM embeddings""",
)
def class_weights(spark, folder):
    rows = sm.with_class_weights(embeddings(spark, folder).select("vec_id", "label"), "label")
    return rows.select("vec_id", "label", rounded(F.col("weight")).alias("weight"))


ANOVA = f"""WITH {FLAT}, c AS (SELECT feature, label, count(*) AS n, avg(value) AS m FROM flat GROUP BY feature, label),
    g AS (SELECT feature, avg(value) AS gm, count(*) AS nn FROM flat GROUP BY feature),
    b AS (SELECT feature, sum(n * (m - gm) * (m - gm)) AS ssb, count(*) AS k FROM c JOIN g USING (feature) GROUP BY feature),
    w AS (SELECT flat.feature, sum((value - m) * (value - m)) AS ssw FROM flat JOIN c ON flat.feature = c.feature AND flat.label = c.label
          GROUP BY flat.feature),
    scores AS (SELECT feature, (ssb / (k - 1)) / (ssw / (nn - k)) AS score FROM b JOIN w USING (feature) JOIN g USING (feature)),
    ranked AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, feature) AS rank FROM scores)"""


def anova(spark, folder):
    return sl.anova_scores(table(spark, folder), COLS, "label")


@register("k01_anova_top", f"{ANOVA} SELECT CAST(rank AS INTEGER) AS rank, feature, {rnd('score', 5)} AS score FROM ranked WHERE rank <= 50")
def anova_top(spark, folder):
    return sl.top_features(anova(spark, folder), 50).withColumn("score", rounded(F.col("score"), 5))


BIN = " + ".join(f"CASE WHEN value > q[{j}] THEN 1 ELSE 0 END" for j in range(1, 10))
DECILES = ", ".join(f"{j / 10}" for j in range(1, 10))


@register(
    "k02_mutual_information_top",
    f"""WITH {FLAT}, e AS (SELECT feature, quantile_cont(value, [{DECILES}]) AS q FROM flat GROUP BY feature),
        c AS (SELECT feature, bin, label, count(*)::DOUBLE AS n FROM (SELECT feature, label, {BIN} AS bin FROM flat JOIN e USING (feature))
              GROUP BY feature, bin, label),
        m AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bin) AS tb,
                     sum(n) OVER (PARTITION BY feature, label) AS tl FROM c),
        scores AS (SELECT feature, sum(n / t * ln(n * t / (tb * tl))) AS score FROM m GROUP BY feature)
        SELECT CAST(rank AS INTEGER) AS rank, feature, {rnd('score')} AS score FROM
        (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, feature) AS rank FROM scores) WHERE rank <= 20""",
)
def mutual_information_top(spark, folder):
    scores = sl.mutual_information(table(spark, folder), COLS, "label")
    return sl.top_features(scores, 20).withColumn("score", rounded(F.col("score")))


#: the 64 columns, one with many equal values and a constant one
TIED = """tied AS (SELECT label, feature, value FROM flat UNION ALL SELECT label, 'same', 2.5::DOUBLE FROM embeddings
    UNION ALL SELECT label, 'ties', floor(value * 4) / 4::DOUBLE FROM flat WHERE feature = 'f00')"""
STEPS = " ".join(f"""{f}(q, {j}) OVER w AS {f}{j},""" for f in ("lag", "lead") for j in (1, 2, 3))
GAPS = ", ".join(f"abs(q - {f}{j})" for f in ("lag", "lead") for j in (1, 2, 3))


@register(
    "k02_neighbour_information",
    f"""WITH {FLAT}, {TIED},
        ends AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM tied WHERE label IS NOT NULL GROUP BY feature),
        grid AS (SELECT feature, label, CAST(floor(CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0 END * 4503599627370496::DOUBLE) AS BIGINT) AS q
                 FROM tied JOIN ends USING (feature) WHERE label IS NOT NULL),
        kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY feature, label) AS nc FROM grid) WHERE nc > 1),
        stepped AS (SELECT feature, label, q, nc, {STEPS} least(3, nc - 1) AS k FROM kept WINDOW w AS (PARTITION BY feature, label ORDER BY q)),
        reach AS (SELECT feature, label, q, nc, k, list_sort(list_filter([{GAPS}], lambda x: x IS NOT NULL))[k] AS gap, greatest(1, gap) - 1 AS r FROM stepped),
        near AS (SELECT feature, nc, CASE WHEN gap = 0 THEN count(*) OVER (PARTITION BY feature, label, q) - 1 ELSE k END AS k,
                        count(*) OVER (PARTITION BY feature ORDER BY q RANGE BETWEEN r PRECEDING AND r FOLLOWING) - CASE WHEN gap = 0 THEN 1 ELSE 0 END AS m,
                        count(*) OVER (PARTITION BY feature) AS n FROM reach),
        psi AS (SELECT i AS x, sum(CASE WHEN i > 1 THEN 1 / (i - 1)::DOUBLE ELSE 0 END) OVER (ORDER BY i) - 0.5772156649015329::DOUBLE AS y
                FROM range(1, (SELECT max(n) + 1 FROM near)) AS t(i)),
        scores AS (SELECT feature, greatest(0, any_value(pn.y) + avg(pk.y - pc.y - pm.y)) AS score
                   FROM near JOIN psi pn ON pn.x = n JOIN psi pk ON pk.x = k JOIN psi pc ON pc.x = nc JOIN psi pm ON pm.x = m GROUP BY feature)
        SELECT feature, {rnd('score')} AS score FROM scores""",
)
def neighbour_information(spark, folder):
    rows = table(spark, folder).withColumns({"same": F.lit(2.5), "ties": F.floor(F.col("f00") * 4) / 4.0})
    scores = sl.neighbour_information(rows, [*COLS, "ties", "same"], "label")
    return scores.select("feature", rounded(F.col("score")).alias("score"))


@register("k05_selected_names", f"{ANOVA} SELECT feature, rank <= 20 AS selected FROM ranked")
def selected_names(spark, folder):
    chosen = sl.selected_names(anova(spark, folder), 20, COLS)
    return anova(spark, folder).select("feature", F.col("feature").isin(chosen).alias("selected"))
