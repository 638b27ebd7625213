"""Personal data in texts: fixed patterns, and further spans chosen by boosted trees.

The patterns find e-mail and IP addresses, card and phone numbers; what they accept always stays. Generators with a wider
net propose overlapping candidates (spelled-out addresses, any run of digits with separators). Every candidate is
described by its format and its context, boosted trees tell how likely it is personal data, and those at or above a
kind's calibrated threshold that don't overlap a better span are added.

A candidate is a positive example if the patterns accept it or a word before it says what it is ("tel", "mail", "card"),
and a negative one otherwise; the trees see its format, never those words. All documents are in one of two halves by a
digest of their text. Each half has trees of its own, fitted to a bounded sample per kind of all its candidates, and the
trees of one half judge the texts of the other, so no text is judged by trees that have seen it. The threshold of a kind is
the least score at which the candidates of that kind that no pattern covers, counted over the whole table, are right often
enough: those are what it decides on, and there only the words before a candidate tell what is right.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.boosting import Boosted, boost
from cardsentry.llm.common import batches, frozen, let_go, mix64

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4_000  # candidates of a kind that the trees of a half are fitted to
STEP = 16  # score counts are kept in steps of 1 / STEP
PRECISION = 0.98
LEAST_EXAMPLES = 20  # of a kind, to trust a threshold

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]")

AT = r"(?:@|\s?[\[(]\s?at\s?[\])]\s?)"
DOT = r"(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)"
SPELLED = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}")
HINT = re.compile(r"@|[\[(]\s?at\s?[\])]")
RUN = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20()./-]{0,3}[0-9]){6,30}(?![0-9A-Za-z])")
SOLID = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[()./-]{0,3}[0-9]){6,30}(?![0-9A-Za-z])")
# words before a candidate that say what it is
CUES = frozenset(
    "tel telephone phone call fax mobile cell whatsapp sms mail email e-mail contact card visa mastercard amex ip host "
    "server telefon anruf teléfono correo tarjeta téléphone courriel carte".split()
)
WORD = re.compile(r"[^\W\d_][\w-]*", re.UNICODE)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def octets(text: str) -> bool:
    """Every part is at most 255, whatever its leading zeros."""
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[Span]:
    """What the patterns accept, by kind and then by start. Time is linear in the text, however long its runs are."""
    out: list[Span] = []
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = m.end() if m else at + 1
    if DIGITS.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if octets(m[0])]
        for m in CARD.finditer(text):
            digits = NOT_DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return out


def proposals(text: str) -> list[Span]:
    """Candidates of all generators; they may overlap."""
    found: dict[tuple[int, int], str] = {}
    if HINT.search(text):
        for m in SPELLED.finditer(text):
            found[m.span()] = "email"
    if DIGITS.search(text):
        for pattern in (RUN, SOLID):
            for m in pattern.finditer(text):
                n = len(NOT_DIGITS.sub("", m[0]))
                parts = re.split(r"[^0-9]+", m[0].strip("+("))
                kind = "ip" if len(parts) == 4 and m[0].count(".") == 3 else "card" if n >= 13 else "phone"
                found.setdefault(m.span(), kind)
    return sorted((kind, *span) for span, kind in found.items())


def words_before(text: str, start: int) -> list[str]:
    return [w.lower() for w in WORD.findall(text[max(0, start - 24) : start])][-3:]


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    s = text[start:end]
    digits = NOT_DIGITS.sub("", s)
    groups = [len(g) for g in re.split(r"[^0-9]+", s) if g]
    before, after = text[start - 1 : start], text[end : end + 1]
    return [
        KINDS.index(kind),
        len(s),
        len(digits),
        sum(c.isalpha() for c in s),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[-1] if groups else 0,
        s.count("."),
        s.count("-"),
        s.count(" "),
        s.count("/"),
        s.count("(") - s.count(")"),
        s.startswith("+"),
        "@" in s,
        bool(digits) and luhn(digits),
        kind == "ip" and octets(s),
        before == "" or before.isspace(),
        after == "" or after.isspace(),
        after in (".", ",", ";"),
        before in (":", "="),
        len(set(digits)),
    ]


def digest_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


@dataclass
class PiiModel:
    trees: tuple[Boosted, Boosted]  # by the half they judge; fitted to the other half
    thresholds: dict[str, float]  # least scores; a kind without one is never added

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Further spans, likeliest first come first served; none overlaps a base span or another."""
        covered = [(s, e) for _, s, e in base]
        wide = [p for p in proposals(text) if p[0] in self.thresholds and all(p[2] <= s or p[1] >= e for s, e in covered)]
        if not wide:
            return []
        score = self.trees[digest_of(text) % 2].raw(np.array([describe(text, p) for p in wide], np.float64))
        out: list[Span] = []
        for p, (kind, start, end) in sorted(zip(-score, wide, strict=True)):
            if -p >= self.thresholds[kind] and all(end <= s or start >= e for _, s, e in out):
                out.append((kind, start, end))
        return out

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), by kind as listed and then by start."""
        base = base_spans(text)
        place = {k: i for i, k in enumerate(KINDS)}
        return base, sorted([*base, *self.added(text, base)], key=lambda s: (place[s[0]], s[1], s[2]))


def candidates(docs: DataFrame) -> DataFrame:
    """(half, kind, key, x, y, free) per candidate of all documents: its description, whether it is a positive example, and
    whether no pattern covers any of it. Keys are spread evenly; the same place in the same text has the same one."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            half, kinds, keys, x, y, free = [], [], [], [], [], []
            for text in part["text"].to_pylist():
                found = proposals(text) if text else []
                if not found:
                    continue
                base, digest = set(base_spans(text)), digest_of(text)
                for p in found:
                    half.append(digest % 2)
                    kinds.append(KINDS.index(p[0]))
                    keys.append((digest + p[1] * 0x9E3779B97F4A7C15 + p[2] * 0xC2B2AE3D27D4EB4F) % 2**64)
                    x.append(np.array(describe(text, p), np.float64).tobytes())
                    y.append(int(p in base or any(w in CUES for w in words_before(text, p[1]))))
                    free.append(all(p[2] <= start or p[1] >= end for _, start, end in base))
            key = pa.array((mix64(np.array(keys, np.uint64)) >> np.uint64(1)).view(np.int64))
            columns = [pa.array(half, pa.int32()), pa.array(kinds, pa.int32()), key, pa.array(x, pa.binary())]
            yield pa.record_batch([*columns, pa.array(y, pa.int32()), pa.array(free, pa.bool_())], ["half", "kind", "key", "x", "y", "free"])
        let_go()

    return docs.select("text").mapInArrow(run, "half int, kind int, key long, x binary, y int, free boolean")


def sample_of(found: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` candidates of each half and kind, those with the smallest keys; of copies of a text, one."""
    own = ["half", "kind"]
    once = found.groupBy(*own, "key").agg(F.min(F.struct("x", "y")).alias("seen"))
    n = {(r["half"], r["kind"]): r["n"] for r in once.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).collect()}
    below = F.lit(0)
    for (half, kind), count in n.items():
        last = 2**63 - 1 if count <= sample else int(2**63 * (sample / count))
        below = F.when((F.col("half") == half) & (F.col("kind") == kind), F.lit(last)).otherwise(below)
    return once.where(F.col("key") <= below).select(*own, "key", "seen.x", "seen.y")


def score_counts(found: DataFrame, trees: tuple[Boosted, Boosted]) -> DataFrame:
    """(kind, step, n, right) of all candidates that no pattern covers: how many have a score in [step, step + 1) / ``STEP``, and how many of those
    are positive examples."""
    shared = found.sparkSession.sparkContext.broadcast(trees)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            x = np.frombuffer(b"".join(part["x"].to_pylist()), np.float64).reshape(part.num_rows, -1)
            half = part["half"].to_numpy()
            score = np.where(half == 0, shared.value[0].raw(x), shared.value[1].raw(x))
            step = pa.array(np.floor(score * STEP).astype(np.int64))
            yield pa.record_batch([part["kind"], step, part["y"]], ["kind", "step", "y"])
        let_go()

    scored = found.where("free").select("half", "kind", "x", "y").mapInArrow(run, "kind int, step long, y int")
    return scored.groupBy("kind", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("right"))


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> PiiModel:
    """Trees from at most about ``sample`` candidates of each half and kind, thresholds from the candidates of all documents.
    A kind of which fewer than ``LEAST_EXAMPLES`` candidates are free of the patterns has no threshold: so few can't show a
    precision, and it stays with its pattern. Repeated rows count each; an empty table gives a model that adds nothing. Only descriptions of sampled candidates and counts reach the driver."""
    found = frozen(candidates(docs))
    got = sample_of(found, sample).toPandas().sort_values(["half", "kind", "key"], kind="stable")

    def grown(half: int) -> Boosted:
        own = got[got["half"] == half]
        if own.empty:
            return Boosted(0.0, [], 0.0, np.zeros(0), np.zeros(0))
        x = np.stack([np.frombuffer(b, np.float64) for b in own["x"]])
        return boost(x, own["y"].to_numpy(np.float64), np.zeros(len(x), bool))

    trees = grown(1), grown(0)
    thresholds = {}
    if got.empty:
        return PiiModel(trees, thresholds)
    counts = sorted((r["kind"], -r["step"], r["n"], r["right"]) for r in score_counts(found, trees).collect())
    for k, name in enumerate(KINDS):
        n = right = 0
        for _, down, more, more_right in (c for c in counts if c[0] == k):
            n, right = n + more, right + more_right
            if n >= LEAST_EXAMPLES and right / n >= precision:
                thresholds[name] = -down / STEP
    return PiiModel(trees, thresholds)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: PiiModel) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, the numbers of base spans by kind, base_sha256 of the base spans, and all
    spans, as kind:start:end in code points, end exclusive. Whole texts are read; null ones count as empty. Repeated rows
    give repeated rows, an empty table an empty one; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counts = [f"n_{k}" for k in KINDS]
    names = ["doc_id", *counts, "base_sha256", "spans", "n_added"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            rows = []
            for text in part["text"].to_pylist():
                base, every = shared.value.spans(text or "")
                kinds = [k for k, *_ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append([*(kinds.count(k) for k in KINDS), digest, joined(every), len(every) - len(base)])
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.record_batch([part["doc_id"], *columns], names)
        let_go()

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in counts), "base_sha256 string, spans string, n_added long"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; overlapping spans are replaced as one, by the
    kind that starts first. Null texts stay null."""
    import pandas as pd

    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([None if t is None else redacted(t, shared.value) for t in part], dtype=object)
        let_go()

    return docs.withColumn("text", clean("text"))


def redacted(text: str, model: PiiModel) -> str:
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in model.spans(text)[1]):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
