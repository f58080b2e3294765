"""Secret scans, with DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: an OR over the ways the expression can
match, each an AND of the trigrams that way must contain. The inverted index holds a posting (trigram, document) for
every trigram some rule asks for. Postings are intersected by counting, the documents left are candidates, and the
expression itself is run over them. A rule with a way that has no trigram is run over every document.

Postings are small; texts are shuffled only where they meet the candidates of the index, and a text whose own trigrams
satisfy no query stays where it was read.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass
from itertools import product
from re import IGNORECASE

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import ROW, text_of, with_row_key, without

#: More ways than this in one expression are not told apart; it is then run over every document.
WAYS = 64
_GAP = "\0"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose `group` is shorter than `least` characters are dropped after matching."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.ignore_case else self.pattern


#: Runs of a character class are matched whole, so a least length may stand in the expression itself.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("personal_token", r"ghp_[A-Za-z0-9]{36,}"),
)


def ways(tree) -> list[str]:
    """The literal runs of every way to match a parsed expression, with a gap where anything may stand."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            step = [chr(arg)]
        elif name == "SUBPATTERN":
            step = ways(arg[-1])
        elif name == "BRANCH":
            step = [w for branch in arg[1] for w in ways(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = arg
            if (least, most) == (0, 1):
                step = ["", *ways(inner)]
            elif least == 0:
                step = ["", _GAP]
            else:
                step = [f"{w}{_GAP}" if (least, most) != (1, 1) else w for w in ways(inner)]
        elif name == "AT":
            step = [""]
        else:
            step = [_GAP]
        out = list(dict.fromkeys(a + b for a, b in product(out, step)))
        if len(out) > WAYS:
            # Keep what is sure whatever way was taken: nothing.
            out = [_GAP]
    return out


def trigram_query(rule: Rule) -> list[frozenset[str]]:
    """An OR over sets of trigrams, all of which a match holds; empty if some way needs none."""
    sets = []
    for way in ways(parser.parse(rule.pattern, IGNORECASE if rule.ignore_case else 0)):
        runs = (way.lower() if rule.ignore_case else way).split(_GAP)
        grams = frozenset(r[k : k + 3] for r in runs for k in range(len(r) - 2) if r.isascii())
        if not grams:
            return []
        sets.append(grams)
    return [s for s in dict.fromkeys(sets) if not any(t < s for t in sets)]


def _running(df: DataFrame, values: str, out: str, of, start: Column) -> DataFrame:
    """Add `out`: the running `of` before each element of the array column `values`, in blocks of about the root of their
    number. The steps are columns of their own, so that each is evaluated once a row."""
    blocks, before, width = f"{out}_blocks", f"{out}_before", f"{out}_width"
    size, block = F.size(values), F.col(width)
    df = df.withColumn(width, F.greatest(F.ceil(F.sqrt(size.cast("double"))).cast("int"), F.lit(1)))
    starts = F.when(size <= 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.floor((size - 1) / block).cast("int")))
    df = df.withColumn(blocks, F.transform(starts, lambda b: F.aggregate(F.slice(values, b * block + 1, block), start, of)))
    df = df.withColumn(before, F.transform(blocks, lambda _, b: F.aggregate(F.slice(blocks, 1, b), start, of)))
    place = lambda i: F.floor(i / block).cast("int")
    own = F.transform(
        values,
        lambda _, i: F.aggregate(
            F.slice(values, place(i) * block + 1, i % block), F.element_at(F.col(before), place(i) + 1), of
        ),
    )
    return df.withColumn(out, own).drop(blocks, before, width)


def satisfied(rules: tuple[Rule, ...], text: str) -> Column:
    """Whether a text's trigrams satisfy the query of some rule that has one."""
    plain, folded = text_of(text), F.lower(text_of(text))
    out = F.lit(False)
    for rule in rules:
        for grams in trigram_query(rule):
            every = F.lit(True)
            for gram in sorted(grams):
                every = every & F.contains(folded if rule.ignore_case else plain, F.lit(gram))
            out = out | every
    return out


def candidates(rows: DataFrame, rules: tuple[Rule, ...], text: str) -> DataFrame | None:
    """ROW and the numbers of the rules whose trigram query the document satisfies; None if every rule scans fully."""
    terms: dict[tuple[str, bool], int] = {}
    table = []
    for number, rule in enumerate(rules):
        for way, grams in enumerate(trigram_query(rule)):
            table += [(terms.setdefault((g, rule.ignore_case), len(terms)), number, way, len(grams)) for g in sorted(grams)]
    if not table:
        return None
    # Bounded by the rules.
    names = ("term", "rule", "way", "needed")
    asked = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row, strict=True)]) for row in table])
    asks = F.broadcast(rows.sparkSession.range(1).select(F.inline(asked)))
    plain, folded = text_of(text), F.lower(text_of(text))
    seen = [F.when(F.contains(folded if fold else plain, F.lit(g)), F.lit(i)) for (g, fold), i in terms.items()]
    postings = rows.select(*ROW, F.explode(F.array_compact(F.array(*seen))).alias("term")).distinct()
    return (
        postings.join(asks, "term")
        .groupBy(*ROW, "rule", "way")
        .agg(F.count("term").alias("found"), F.first("needed").alias("needed"))
        .where(F.col("found") == F.col("needed"))
        .groupBy(*ROW)
        .agg(F.collect_set("rule").alias("_llm_rules"))
    )


def _spans(rows: DataFrame, number: int, rule: Rule, text: str) -> DataFrame:
    """Add the rule's spans, found by splitting the text at its matches: lengths of what lies between give the places."""
    value, pattern = F.col(text), F.lit(rule.java)
    wanted = F.rlike(value, pattern)
    if trigram_query(rule):
        wanted = F.array_contains("_llm_rules", number) & wanted
    part = lambda name: f"_llm_{name}_{number}"
    length = lambda xs: F.transform(xs, lambda x: F.char_length(x).cast("long"))
    found = rows.withColumn(part("gap"), F.when(wanted, length(F.split(value, rule.java, -1))))
    found = found.withColumn(part("len"), F.when(wanted, length(F.regexp_extract_all(value, pattern, F.lit(0)))))
    if rule.least:
        inner = length(F.regexp_extract_all(value, pattern, F.lit(rule.group)))
        found = found.withColumn(part("group"), F.when(wanted, inner))
    gap, size = F.col(part("gap")), F.col(part("len"))
    found = found.withColumn(part("both"), F.zip_with(F.slice(gap, 1, F.size(size)), size, lambda g, n: g + n))
    found = _running(found, part("both"), part("step"), lambda a, x: a + x, F.lit(0).cast("long"))
    span = F.transform(
        F.col(part("step")),
        lambda before, i: F.struct(
            (before + F.element_at(gap, i + 1)).alias("start"),
            F.lit(number).alias("rule"),
            (before + F.element_at(gap, i + 1) + F.element_at(size, i + 1)).alias("end"),
            F.lit(rule.kind).alias("kind"),
            (F.element_at(F.col(part("group")), i + 1) if rule.least else F.lit(0).cast("long")).alias("inner"),
        ),
    )
    names = [part(x) for x in ("gap", "len", "group", "both", "step")]
    return found.withColumn(part("span"), F.filter(span, lambda s: s["inner"] >= rule.least)).drop(*names)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text", doc_id: str = "doc_id", out: str = "secrets"
) -> DataFrame:
    """Add `out`: an array of (start, end, kind), ordered by start, then by the order of the rules. Places are code
    points, the end exclusive. Within a kind matches are leftmost and do not overlap; kinds may.

    A null or empty text has no secrets (an empty array); a null one becomes empty. Rows that share an id or are repeated are each scanned.
    An empty table gives an empty one. Other columns stay; one called `out` is replaced.
    """
    given = without(docs, [out])
    rows = with_row_key(given, doc_id, text)
    numbered = list(enumerate(rules))
    found = candidates(rows, rules, text)
    if found is None:
        return _scanned(rows, numbered, text, out).select(*given.columns, out)
    asked = satisfied(rules, text)
    free = _scanned(rows.where(~asked), [(n, rule) for n, rule in numbered if not trigram_query(rule)], text, out)
    met = _scanned(rows.where(asked).join(found, list(ROW), "left"), numbered, text, out)
    return free.select(*given.columns, out).unionByName(met.select(*given.columns, out))


def _scanned(rows: DataFrame, rules: list[tuple[int, Rule]], text: str, out: str) -> DataFrame:
    """Add `out` for these numbered rules."""
    rows = rows.withColumn(text, text_of(text))
    for number, rule in rules:
        rows = _spans(rows, number, rule, text)
    none = F.array().cast("array<struct<start: long, rule: int, end: long, kind: string, inner: long>>")
    every = F.concat(none, *[F.coalesce(F.col(f"_llm_span_{n}"), none) for n, _ in rules])
    named = lambda s, *names: F.struct(*[s[n].alias(n) for n in names])
    return rows.withColumn(out, F.transform(F.array_sort(every), lambda s: named(s, "start", "end", "kind")))


def redact(
    docs: DataFrame, mark: str = "[secret]", text: str = "text", secrets: str = "secrets"
) -> DataFrame:
    """Replace what the spans of `secrets` cover by `mark`, overlapping or touching spans by one mark.

    A text without spans stays as it is, null included."""
    ends, reached = "_llm_ends", "_llm_reached"
    spans, value = F.col(secrets), text_of(text)
    df = docs.withColumn(ends, F.transform(spans, lambda s: s["end"]))
    df = _running(df, ends, reached, lambda a, x: F.greatest(a, x), F.lit(0).cast("long"))
    open_ = F.zip_with(
        spans, reached, lambda s, before: F.struct(before.alias("from"), s["start"].alias("to"))
    )
    # What lies between spans; the first piece may be empty, later ones are only there where spans don't touch.
    pieces = F.transform(
        F.filter(open_, lambda p, i: (i == 0) | (p["to"] > p["from"])),
        lambda p: F.substring(value, p["from"].cast("int") + 1, F.greatest(p["to"] - p["from"], F.lit(0)).cast("int")),
    )
    tail = F.substring(value, F.array_max(ends).cast("int") + 1, F.char_length(value))
    clean = F.array_join(F.concat(pieces, F.array(tail)), mark)
    return df.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(F.col(text))).drop(ends, reached)
