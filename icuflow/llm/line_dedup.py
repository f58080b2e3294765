"""Removal of lines that many documents share, with DataFrame functions only.

Lines are exploded with their position and normalised, each key is hashed, and the hashes are written once. Documents are
counted per hash with partial aggregation, so a line that a third of all documents hold is a few rows per task by the time
it is shuffled, and what is known of such a line is broadcast to its places instead of bringing these together. Only
positions come back to the documents; the text is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import ROW, looked_up, text_of, with_row_key, without, written

#: White space that is stripped from a line's ends: fixed values.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bare(line: Column) -> Column:
    """A line without white space at its ends. Most lines have none there, and a look at the ends is cheaper than a trim."""
    ends = F.substring(line, 1, 1).isin(*BLANK) | F.substring(line, -1, 1).isin(*BLANK)
    return F.when(ends, F.trim(line, F.lit(BLANK))).otherwise(line)


def _lowered(line: Column) -> Column:
    """A-Z in lower case. Plain ASCII takes the fast way, which would also change other letters elsewhere."""
    plain = F.octet_length(line) == F.char_length(line)
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def line_hashes(text: Column, min_chars: int) -> Column:
    """An array with the hash of each line's key, null for a key of fewer than `min_chars` code points.

    One step of an array at a time, so that no line is trimmed, lowered or hashed twice.
    """
    long = lambda x: F.when(F.char_length(x) >= min_chars, x)
    lines = F.transform(F.split(text, "\n", -1), long)
    keys = F.transform(F.transform(F.transform(lines, _bare), long), _lowered)
    return F.transform(keys, lambda key: F.unhex(F.md5(key)))


def drop_shared_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Drop lines whose key has at least `min_chars` code points and is held by at least `min_docs` documents, except
    in the largest document id that holds it. `text` becomes the kept lines, joined by line feeds; `n_lines` (before)
    and `n_dropped` are added.

    A null or empty text is one empty line. A document whose lines all go keeps an empty text. Rows that share a
    document id are one document for the counts, and each of them is returned; rows without an id together count as one
    document below all others. A line repeated inside a document goes or stays as a whole. An empty table gives an empty
    one. Other columns stay; those called `n_lines` or `n_dropped` are replaced.
    """
    given = without(docs, [x for x in ("n_lines", "n_dropped") if x not in (text, doc_id)])
    rows = with_row_key(given, doc_id, text)
    lines = rows.select(*ROW, F.posexplode(line_hashes(text_of(text), min_chars)).alias("pos", "hash"))
    keyed = written(lines.where(F.col("hash").isNotNull()))
    shared = (
        keyed.groupBy("hash", ROW[0])
        .agg(F.count(F.lit(1)).alias("places"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("places").alias("places"), F.max(ROW[0]).alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("hash", "places", "keeper")
    )
    dropped = (
        looked_up(keyed, written(shared), "hash", "places", keyed.count(), "inner")
        .where(F.col(ROW[0]) != F.col("keeper"))
        .groupBy(*ROW)
        .agg(F.collect_set("pos").alias("_line_gone"))
    )
    line, gone = F.col("_line_parts"), F.col("_line_gone")
    every = F.sequence(F.lit(0), F.size(line) - 1)
    rest = F.transform(F.array_except(every, gone), lambda p: F.element_at(line, p + 1))
    # The lines are a column of their own: inside the lambda the text would be split anew for every kept line.
    return (
        rows.join(dropped, list(ROW), "left")
        .withColumn("_line_parts", F.split(text_of(text), "\n", -1))
        .withColumn("n_lines", F.size(line).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(gone), F.lit(0)).cast("long"))
        .withColumn(text, F.when(gone.isNull(), text_of(text)).otherwise(F.array_join(rest, "\n")))
        .select(*given.columns, "n_lines", "n_dropped")
    )
