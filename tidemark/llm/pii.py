"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them,
a span classifier learns from the result.

Candidates are the base matches (email, ip, card, phone), base matches whose check fails,
and looser forms: spelled-out addresses, local phone numbers, national ids, account
numbers. Each labeler votes for (+1) or against (-1) a candidate or abstains (0):

* pattern: does the strict form hold, checksum and ranges included;
* gazetteer: known top-level domains, country codes, card issuers, reserved networks;
* context: telling words to the left, for this kind of data or for something else;
* border: is the candidate a token of its own or part of a longer one;
* grouping: are its digits grouped the way people write them.

The tasks count how often each combination of kind, votes and shape occurs; there are at
most ``len(KINDS) * 3 ** 5 * SHAPES`` of them however large the corpus, and only they reach
the driver. Expectation-maximisation estimates, per kind, how often the data are personal
and how each labeler votes if they are or are not; a logistic regression over votes, kind
and shape is then fitted to the estimated labels. Base matches are always kept; other
candidates are kept where the classifier says at least ``KEEP`` and no kept span overlaps.

Null texts count as empty. Repeated rows are judged alike. Offsets count code points, ends
exclusive. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, stored, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national_id", "account")
LABELERS = ("pattern", "gazetteer", "context", "border", "grouping")
SHAPES = 16
KEEP = 0.5
ROUNDS = 50

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number's dotted parts are taken whole, and only from where the digits begin: the same
# matches as without both, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"\x20?[\[(]at[\])]\x20?([A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)"
                      r"[A-Za-z0-9-]+)+)")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}"
                          r"|0[0-9]{2,4}[\x20/-][0-9]{5,8})(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}(?![A-Za-z0-9])")

# Gazetteers; small on purpose, the votes are weighed.
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"}
COUNTRY_CODES = ("1", "33", "34", "39", "41", "43", "44", "49", "351")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
FOR = {
    "email": {"mail", "email", "contact", "kontakt", "contacto", "write", "an"},
    "ip": {"ip", "host", "server", "address", "from", "client"},
    "card": {"card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "ring"},
    "national_id": {"ssn", "social", "security", "id", "identity"},
    "account": {"iban", "account", "konto", "compte", "cuenta", "bank"},
}
AGAINST = {"version", "release", "order", "invoice", "total", "page", "price", "isbn", "issn",
           "section", "chapter", "figure", "build", "sku", "item"}
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each ``@``."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        before = text[free:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        free = at + 1
        if domain and local:
            out.append((at - local, domain.end()))
            free = domain.end()
        at = text.find("@", free)
    return out


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_matches(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans by kind as listed, and the matches that failed their check."""
    good = [("email", a, b) for a, b in emails(text)]
    bad: list[tuple[str, int, int]] = []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            (good if all(map(_small, m[0].split("."))) else bad).append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                good.append(("card", *m.span()))
            elif 13 <= len(digits) <= 19:
                bad.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            ok = 8 <= len(_digits(m[0])) <= 15
            (good if ok else bad).append(("phone", *m.span()))
    return good, bad


def loose_matches(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "at)" in text or "at]" in text:
        for m in _SPELLED.finditer(text):
            before = text[max(0, m.start() - 64):m.start()]
            local = len(before) - len(before.rstrip(_LOCAL))
            if local:
                out.append(("email", m.start() - local, m.end()))
    if _DIGIT.search(text):
        for kind, pattern in (("phone", _LOCAL_PHONE), ("national_id", _NATIONAL),
                              ("account", _ACCOUNT)):
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def _gazetteer(kind: str, span: str, digits: str) -> int:
    if kind == "email":
        return 1 if span.rpartition(".")[2].lower() in TOP_DOMAINS else 0
    if kind == "ip":
        return -1 if span.split(".")[0] in ("0", "127", "255") else 1
    if kind == "card":
        return 1 if digits.startswith(ISSUERS) else -1
    if kind == "phone":
        return 0 if span[0] != "+" else 1 if digits.startswith(COUNTRY_CODES) else -1
    if kind == "national_id":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" else 1
    return 0


def _grouping(kind: str, span: str) -> int:
    groups = re.findall("[0-9]+", span)
    if kind == "card":
        return 1 if len(groups) == 1 or all(len(g) == 4 for g in groups[:-1]) else -1
    if kind == "phone":
        return -1 if len(groups) > 6 or max(map(len, groups)) > 12 else 1
    return 0


def votes(text: str, kind: str, start: int, end: int, strict: int) -> tuple[int, ...]:
    span = text[start:end]
    digits = _digits(span)
    left = {w.lower() for w in _WORD.findall(text[max(0, start - 32):start])}
    context = 1 if left & FOR[kind] else -1 if left & AGAINST else 0
    around = text[max(0, start - 1):start] + text[end:end + 1]
    border = -1 if any(c.isalnum() or c in "_@" for c in around) else 1
    return (strict, _gazetteer(kind, span, digits), context, border, _grouping(kind, span))


def shape(span: str) -> int:
    """Length and share of digits in four steps each."""
    size = min(3, len(span) // 8)
    share = sum(map(str.isdigit, span)) / max(1, len(span))
    return 4 * size + min(3, int(share * 4))


def candidates(text: str | None) -> tuple[list, list]:
    """Base spans (kind, start, end), and all candidates (kind, start, end, votes, shape,
    whether base)."""
    text = text or ""
    good, bad = base_matches(text)
    rows = [(k, a, b, votes(text, k, a, b, 1), shape(text[a:b]), True) for k, a, b in good]
    seen = set(good)
    for strict, found in ((-1, bad), (0, loose_matches(text))):
        for k, a, b in found:
            if (k, a, b) not in seen:
                seen.add((k, a, b))
                rows.append((k, a, b, votes(text, k, a, b, strict), shape(text[a:b]), False))
    return good, rows


def pattern_code(kind: str, vote: tuple[int, ...], form: int) -> int:
    code = KINDS.index(kind)
    for v in vote:
        code = code * 3 + v + 1
    return code * SHAPES + form


def decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    form, rest = codes % SHAPES, codes // SHAPES
    n = len(LABELERS)
    vote = np.stack([rest // 3 ** (n - 1 - j) % 3 for j in range(n)], axis=1)
    return rest // 3 ** n, vote, form


def reliabilities(kind: np.ndarray, vote: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Expectation-maximisation with one hidden label per candidate and, given the label
    and the kind, independent votes. Returns the probability of personal data per row.
    The first guess is the share of votes for it."""
    score = (vote - 1).sum(axis=1)
    q = 1 / (1 + np.exp(-score.astype(float)))
    for _ in range(ROUNDS):
        new = np.empty_like(q)
        for k in np.unique(kind):
            own = kind == k
            logs = []
            for label in (q[own], 1 - q[own]):
                w = n[own] * label
                total = w.sum()
                log = np.full(own.sum(), np.log(total + 1))
                for j in range(vote.shape[1]):
                    by = np.bincount(vote[own, j], weights=w, minlength=3)
                    log += np.log((by + 1) / (total + 3))[vote[own, j]]
                logs.append(log)
            new[own] = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        done = np.abs(new - q).max(initial=0) < 1e-9
        q = new
        if done:
            break
    return q


def _features(kind: np.ndarray, vote: np.ndarray, form: np.ndarray) -> np.ndarray:
    parts = [np.eye(len(KINDS))[kind], np.eye(SHAPES)[form]]
    parts += [np.eye(3)[vote[:, j]] for j in range(vote.shape[1])]
    return np.concatenate(parts, axis=1)


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(*decode(codes)) @ self.weights, -50, 50)))


def fit(codes: np.ndarray, n: np.ndarray) -> Classifier:
    """Ridge logistic regression on the estimated labels, by Newton steps."""
    order = np.argsort(codes)
    codes, n = codes[order], n[order].astype(float)
    size = _features(*decode(np.zeros(1, np.int64))).shape[1]
    weights = np.zeros(size)
    if not len(codes):
        return Classifier(weights)
    kind, vote, form = decode(codes)
    label = reliabilities(kind, vote, n)
    x = _features(kind, vote, form)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        slope = x.T @ (n * (label - p)) - weights
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(size)
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(weights)


def choose(rows: list[tuple], probability: dict[int, float]) -> list[tuple[str, int, int]]:
    """Base spans, and the likeliest other candidates that overlap nothing kept. Rows are
    (kind, start, end, code, whether base)."""
    kept = [(k, a, b) for k, a, b, _, base in rows if base]
    more = sorted((-probability[code], a, b, k) for k, a, b, code, base in rows
                  if not base and probability[code] >= KEEP)
    for _, a, b, k in more:
        if all(b <= x or y <= a for _, x, y in kept):
            kept.append((k, a, b))
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                   ("code", pa.int64()), ("base", pa.bool_())])
_SPAN_SQL = "array<struct<kind:string,start:long,end:long,code:long,base:boolean>>"


def find_candidates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): every candidate of every row, with its combination of votes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = [[{"kind": k, "start": a, "end": b, "code": pattern_code(k, v, f),
                       "base": base} for k, a, b, v, f, base in candidates(t)[1]]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(_SPAN))], ["doc_id", "found"])

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, found {_SPAN_SQL}")


def train(found: DataFrame) -> Classifier:
    counts = (found.select(F.explode("found.code").alias("code")).groupBy("code")
              .agg(F.count(F.lit(1)).alias("n")).toArrow())  # bounded, see above
    return fit(counts.column("code").to_numpy(), counts.column("n").to_numpy())


def _hex(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(_said(spans).encode()).hexdigest()


def _said(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found): base counts and
    all kept spans; ``found`` has the kept spans as (kind, start, end)."""
    kept = stored(find_candidates(df, doc_id, text), "candidates")
    model = train(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[(x["kind"], x["start"], x["end"], x["code"], x["base"]) for x in r or []]
                    for r in batch.column(1).to_pylist()]
            codes = sorted({x[3] for r in rows for x in r})
            chance = dict(zip(codes, model.probability(np.array(codes, np.int64)).tolist())
                          ) if codes else {}
            base = [sorted(((k, a, b) for k, a, b, _, ok in r if ok),
                           key=lambda s: (KINDS.index(s[0]), s[1])) for r in rows]
            spans = [choose(r, chance) for r in rows]
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array([sum(s[0] == k for s in r) for r in base], pa.int64()) for k in BASE]
                + [pa.array(map(_hex, base), pa.string()), pa.array(map(_said, spans), pa.string()),
                   pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in r] for r in spans],
                            pa.list_(span))],
                ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "found"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return kept.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, "
                                "found array<struct<kind:string,start:long,end:long>>")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every kept span of ``text`` replaced by its kind in angle brackets.
    Overlapping spans are replaced as one, under the name of the first."""
    columns = df.columns
    at = columns.index(text)
    kept = stored(find_candidates(df.select(F.lit(0).alias("doc_id"), text), text=text),
                  "candidates")
    model = train(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            out = []
            for t in batch.column(at).to_pylist():
                rows = [(k, a, b, pattern_code(k, v, f), base)
                        for k, a, b, v, f, base in candidates(t)[1]]
                codes = sorted({r[3] for r in rows})
                chance = dict(zip(codes, model.probability(np.array(codes, np.int64)).tolist())
                              ) if codes else {}
                out.append(masked(t, choose(rows, chance)))
            columns_out = list(batch.columns)
            columns_out[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns_out, batch.schema.names)

    return df.mapInArrow(run, df.schema)


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    if not spans:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    return detect(table(spark, sf_dir, "documents")).drop("found")
