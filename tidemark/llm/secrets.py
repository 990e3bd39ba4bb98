"""Secret scan over a trigram inverted index, with DataFrame operations only.

Each rule is a regular expression. From its parse tree follow strings of which some must
occur in every match, and from those a Boolean query over trigrams: all trigrams of one
string, for one string of every group. The index maps each trigram that a query names to
the rows that have it; intersecting its postings leaves the candidates of a rule, and the
expression itself verifies them. Rules without mandatory trigrams are run over every text.

Texts are indexed in lower case, so that rules in either case use one index; a text that
has a string also has it in lower case, so no match is lost. Matches
are leftmost and do not overlap within a rule; offsets count code points, ends exclusive.
The text between matches and the matches themselves, both from the expression, give the
offsets by a running sum.

Null texts count as empty. Repeated rows (same doc_id and text) get equal results. Other
columns are not read.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _constants as token
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_hash, stored, table

# A set of characters is spelled out up to this many, a group of strings up to that many.
MOST_CHARS, MOST_STRINGS = 5, 40


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and Python. A match counts if the text of
    ``group`` has at least ``least`` characters; others are dropped, without a retry."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, in order.
BASE = (
    Rule("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|"""
                   r"""[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
                   r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),  # the runs of [0-9a-f]+ that are long enough
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE


def _product(a: set[str], b: set[str]) -> set[str] | None:
    out = {x + y for x, y in itertools.product(a, b)}
    return out if len(out) <= MOST_STRINGS else None


def _exact(node) -> set[str] | None:
    """All strings a part of an expression can match, lower-cased; None if too many."""
    kind, value = node
    if kind is token.LITERAL:
        return {chr(value).lower()}
    if kind is token.IN:
        found: set[str] = set()
        for k, v in value:
            if k is token.LITERAL:
                found.add(chr(v).lower())
            elif k is token.RANGE and v[1] - v[0] < 2 * MOST_CHARS:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= MOST_CHARS else None
    if kind is token.SUBPATTERN:
        return _exact_all(value[3])
    if kind is token.BRANCH:
        parts = [_exact_all(b) for b in value[1]]
        return set().union(*parts) if None not in parts else None
    if kind is token.MAX_REPEAT:
        low, high, inner = value
        one = _exact_all(inner)
        if one is None or high > 8:
            return None
        out, power = set(), {""}
        for n in range(high + 1):
            if n >= low:
                out |= power
            power = _product(power, one)
            if power is None:
                return None
        return out
    return None


def _exact_all(nodes) -> set[str] | None:
    out: set[str] | None = {""}
    for node in nodes:
        part = _exact(node)
        out = None if part is None else _product(out, part)
        if out is None:
            return None
    return out


def _usable(strings: set[str]) -> list[frozenset[str]]:
    """The strings of a group as trigram sets; none if some string is shorter than three."""
    shortest = {s for s in strings if not any(o != s and o in s for o in strings)}
    if any(len(s) < 3 for s in shortest):
        return []
    return [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(shortest)]


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Groups of trigram sets: every match has, of each group, all trigrams of one set."""
    def groups(nodes) -> list[set[str]]:
        out, now = [], {""}
        for node in nodes:
            part = _exact(node)
            both = _product(now, part) if part is not None else None
            if both is not None:
                now = both
                continue
            out.append(now)
            now = {""} if part is None else part
            if part is None:
                kind, value = node
                if kind is token.SUBPATTERN:
                    out += groups(value[3])
                elif kind is token.MAX_REPEAT and value[0] > 0:
                    out += groups(value[2])
        return [*out, now]

    return [q for g in groups(parser.parse(pattern)) if (q := _usable(g))]


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, h) of the trigrams asked for."""
    low = docs.select("doc_id", row_hash(F.col("doc_id"), F.col("text")).alias("h"),
                      F.lower("text").alias("low"))
    there = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    return (low.select("doc_id", "h", F.explode(F.array_compact(there)).alias("trigram"))
            .distinct())



def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, h, rule): rows that may have a match, each once per rule."""
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    plan = [(name, g, s, t, len(strings)) for name, groups in queries.items()
            for g, group in enumerate(groups) for s, strings in enumerate(group)
            for t in sorted(strings)]
    wanted = {name: len(groups) for name, groups in queries.items()}
    spark = docs.sparkSession
    full = [r for r in rules if not wanted[r.name]]
    found = []
    if plan:
        postings = stored(index(docs, sorted({p[3] for p in plan})), "postings")
        # one row per trigram of a rule: its size depends on the rules alone
        asked = spark.createDataFrame(
            [(*p, wanted[p[0]]) for p in plan],
            "rule string, g int, s int, trigram string, need int, groups int")
        found.append(
            postings.join(F.broadcast(asked), "trigram")
            .groupBy("doc_id", "h", "rule", "groups", "g", "s", "need")
            .agg(F.count(F.lit(1)).alias("n")).filter("n = need")
            .groupBy("doc_id", "h", "rule", "groups").agg(F.count_distinct("g").alias("n"))
            .filter("n = groups").select("doc_id", "h", "rule"))
    if full:
        hit = F.array_compact(F.array(*[
            F.when(F.col("text").rlike(r.pattern), F.lit(r.name)) for r in full]))
        found.append(docs.select("doc_id", row_hash(F.col("doc_id"), F.col("text")).alias("h"),
                                 F.explode(hit).alias("rule")).distinct())
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, h, rule, start, end): every match that counts."""
    picked = stored(candidates(docs, rules).groupBy("doc_id", "h")
                    .agg(F.collect_set("rule").alias("rules")), "candidates")
    rows = docs.select("doc_id", row_hash(F.col("doc_id"), F.col("text")).alias("h"), "text")
    texts = rows.join(picked, _same_row(rows, picked)).select(
        rows["doc_id"], rows["h"], "text", "rules")

    def matches(r: Rule) -> Column:
        pattern, text = F.lit(r.pattern), F.col("text")
        whole = F.regexp_extract_all(text, pattern, F.lit(0))
        sized = whole if not r.group else F.regexp_extract_all(text, pattern, F.lit(r.group))
        each = F.arrays_zip(whole.alias("m"), sized.alias("s"),
                            F.split(text, r.pattern, -1).alias("gap"))
        return F.when(F.array_contains("rules", r.name), F.transform(each, lambda x, i: F.struct(
            F.lit(r.name).alias("rule"), i.alias("i"), F.length(x["gap"]).alias("gap"),
            F.length(x["m"]).alias("size"), (F.length(x["s"]) >= r.least).alias("counts"))))

    found = texts.select("doc_id", "h", F.array_compact(F.array(*map(matches, rules))).alias("by"))
    found = (found.select("doc_id", "h", F.explode(F.flatten("by")).alias("x"))
             .select("doc_id", "h", "x.*")
             .groupBy("doc_id", "h", "rule", "i")  # repeated rows become one
             .agg(*[F.first(c).alias(c) for c in ("gap", "size", "counts")]))
    so_far = Window.partitionBy("doc_id", "h", "rule").orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(so_far)
    return (found.withColumn("end", end).filter("counts")
            .select("doc_id", "h", "rule", (F.col("end") - F.col("size")).alias("start"), "end"))


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])


def scan(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every document row."""
    rules = BASE + more
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    found = spans(docs, rules)
    entry = F.struct("start", order[F.col("rule")].alias("kind"), "end",
                     F.concat_ws(":", "rule", "start", "end").alias("said"))
    base = F.col("rule").isin(*[r.name for r in BASE])
    counts = [F.count_if(F.col("rule") == r.name).alias(f"n_{r.name}") for r in BASE]
    by_row = found.groupBy("doc_id", "h").agg(
        *counts, F.array_sort(F.collect_list(F.when(base, entry))).alias("base"),
        F.array_sort(F.collect_list(entry)).alias("all"))
    rows = docs.select("doc_id", row_hash(F.col("doc_id"), F.col("text")).alias("h"))
    said = {c: F.coalesce(F.concat_ws(",", F.col(f"{c}.said")), F.lit("")) for c in ("base", "all")}
    return rows.join(by_row, _same_row(rows, by_row), "left").select(
        rows["doc_id"], *[F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}")
                          for r in BASE],
        F.sha2(said["base"], 256).alias("base_sha256"), said["all"].alias("spans"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return scan(table(spark, sf_dir, "documents"))
