"""Queries: decision trees by information gain and gain ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.operators import metrics, prep, trees
from icuflow.plans.q_tables import rounded
from icuflow.plans.registry import query
from icuflow.session import stable



def labelled_documents(t) -> DataFrame:
    """Documents with a quality label: language, source, length in characters, words and bands of 200 words."""
    words = F.size(F.split("text", " "))
    band = F.least(F.floor(words / 200), F.lit(5)).cast("string")
    rows = t.documents.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "n_chars", words.alias("n_words"), band.alias("band")
    )
    return rows.join(t.labels.select("doc_id", "quality"), "doc_id").where("quality IS NOT NULL")


SOURCE = """SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, n_chars, len(string_split(text, ' ')) AS n_words,
  CAST(least(len(string_split(text, ' ')) // 200, 5) AS VARCHAR) AS band, quality AS y FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL"""


def id3_sql(attributes: list[str], depth: int, rows: str) -> str:
    """SQL for a tree by information gain, a group of steps a level."""
    columns = ", ".join(attributes)
    parts = [f"r0 AS (SELECT '' AS path, y, {columns} FROM ({rows}))"]
    out = []
    for k in range(depth + 1):
        size = f"(SELECT path, count(*) AS n FROM r{k} GROUP BY path)"
        if k == depth:
            out.append(f"SELECT path, NULL AS attribute, NULL AS gain, n FROM {size}")
            break
        long = " UNION ALL ".join(f"SELECT path, {i} AS a, {name} AS value, y FROM r{k}" for i, name in enumerate(attributes))
        name = "CASE a " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(attributes)) + " END"
        value = "CASE a " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(attributes)) + " END"
        parts += [
            f"h{k} AS (SELECT path, sum(n) AS n, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM (SELECT path, y, count(*) AS n FROM r{k} GROUP BY ALL) GROUP BY path)",
            f"v{k} AS (SELECT path, a, value, sum(n) * log2(sum(n)) - sum(n * log2(n)) AS e FROM (SELECT path, a, value, y, count(*) AS n FROM ({long}) GROUP BY ALL) GROUP BY ALL)",
            f"g{k} AS (SELECT path, a, any_value(n) AS n, any_value(h) - sum(e) / any_value(n) AS gain FROM v{k} JOIN h{k} USING (path) WHERE n >= 4 GROUP BY path, a HAVING count(*) > 1)",
            f"b{k} AS (SELECT * FROM g{k} WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY path ORDER BY round(gain, 9) DESC, a) = 1)",
            f"r{k + 1} AS (SELECT path || '/' || {name} || '=' || {value} AS path, y, {columns} FROM r{k} JOIN b{k} USING (path))",
        ]
        out.append(f"SELECT s.path, {name} AS attribute, round(b.gain, 6) AS gain, s.n FROM {size} s LEFT JOIN b{k} b USING (path)")
    return f"WITH {', '.join(parts)} SELECT path, attribute, CAST(gain AS DOUBLE) AS gain, CAST(n AS DOUBLE) AS weight FROM ({' UNION ALL '.join(out)})"


@query(id3_sql(["lang", "source", "band"], 2, SOURCE))
def fit_id3(t):
    tree, cuts = trees.grow(labelled_documents(t), ["lang", "source", "band"], "quality", depth=2)
    found = [(path, name, gain, weight) for path, name, _, gain, weight in trees.described(tree, cuts)]
    return rounded(t.spark.createDataFrame(found, "path string, attribute string, gain double, weight double"))


@query(
    f"""WITH r AS ({SOURCE}),
    x AS (SELECT 'n_chars' AS name, 2 AS a, n_chars AS v, y FROM r UNION ALL SELECT 'n_words', 3, n_words, y FROM r),
    placed AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY v) - 1 AS rank, count(*) OVER (PARTITION BY name) AS n FROM x),
    cuts AS (SELECT DISTINCT name, v AS cut FROM placed, range(1, 16) t(j) WHERE rank = n * j // 16),
    side AS (SELECT x.name, a, cut, CASE WHEN v <= cut THEN 'low' ELSE 'high' END AS branch, y, count(*) AS n FROM x JOIN cuts USING (name) GROUP BY ALL
      UNION ALL SELECT 'lang', 0, NULL, lang, y, count(*) FROM r GROUP BY ALL UNION ALL SELECT 'source', 1, NULL, source, y, count(*) FROM r GROUP BY ALL),
    part AS (SELECT name, a, cut, branch, sum(n) AS n, sum(n) * log2(sum(n)) - sum(n * log2(n)) AS e FROM side GROUP BY ALL),
    whole AS (SELECT sum(n) AS n, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM (SELECT y, count(*) AS n FROM r GROUP BY y)),
    split AS (SELECT name, a, cut, any_value(h) - sum(e) / any_value(w.n) AS gain, log2(any_value(w.n)) - sum(p.n * log2(p.n)) / any_value(w.n) AS info,
      list_sort(list(p.n), 'DESC')[2] AS second FROM part p, whole w GROUP BY name, a, cut HAVING count(*) > 1),
    best AS (SELECT * FROM split QUALIFY row_number() OVER (PARTITION BY name ORDER BY round(gain, 12) DESC, cut) = 1),
    fine AS (SELECT * FROM best WHERE gain > 1e-12 AND second >= 2 AND info > 1e-12)
    SELECT name AS attribute, CAST(cut AS DOUBLE) AS cut, round(gain / info, 6) AS gain, CAST((SELECT n FROM whole) AS DOUBLE) AS weight FROM fine
    WHERE gain >= (SELECT avg(gain) FROM fine) - 1e-9 QUALIFY row_number() OVER (ORDER BY round(gain / info, 9) DESC, a) = 1"""
)
def c45_root(t):
    tree, cuts = trees.grow(labelled_documents(t), ["lang", "source", "n_chars", "n_words"], "quality", ["n_chars", "n_words"], ratio=True, depth=1)
    found = [(name, cut, gain, weight) for path, name, cut, gain, weight in trees.described(tree, cuts) if not path]
    return rounded(t.spark.createDataFrame(found, "attribute string, cut double, gain double, weight double"))


@query()
def fit_c45(t):
    # A pruned tree of the md5-split training part; accuracy and area by the certainty of the rest.
    rows = stable(prep.hash_split(labelled_documents(t), "doc_id", 0.7))
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    tree, cuts = trees.grow(train, ["lang", "source", "n_chars", "n_words"], "quality", ["n_chars", "n_words"], ratio=True, prune=True)
    scored = stable(trees.predict(test, "doc_id", tree, cuts).join(test.select("doc_id", "quality"), "doc_id"))
    certain = scored.withColumn("score", F.round(F.get("certainty", F.lit(len(tree.classes) - 1)), 9))
    area = metrics.auroc(certain, "score", "quality").select("auroc")
    right = metrics.accuracy(scored, "prediction", "quality").select(F.col("n").alias("n_test"), "accuracy")
    return rounded(right.withColumns({"auroc": area.scalar(), "nodes": F.lit(len(tree.nodes))}))
