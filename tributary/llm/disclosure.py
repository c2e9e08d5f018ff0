"""Personal data, and the terms that give it away.

base_spans() finds e-mail addresses, IPv4 addresses, payment cards and phone numbers by their patterns; secrets() finds
strings whose letters and digits alternate like those of random keys. These are the protected entities; an address, a
card or a phone number also counts as its coarser entity (mail domain, network, issuer, area). A term is a word within
WINDOW words of an entity. Over the N rows, all counted as documents:

    IC(e) = -log2(df(e) / N)          what it takes to name the entity
    PMI(e; t) = log2(P(e | t) N / df(e))    what the term tells of it
    disclosure(e; t) = PMI / IC       1 if the term names the entity for sure, 0 if it tells nothing

P(e | t) is the lower Wilson bound, CAUTION standard deviations wide, of the share co(e, t) / df(t): the documents that
hold the term near the entity among all that hold it. So one observation is weaker evidence than many, but it is evidence:
a word that occurs in a single document, next to an address, discloses 1 - 1 / log2(N) of it. A term's disclosure is the
largest over the entities that it is near, coarser ones too. Terms of GENERALISE or more become their class (number, name
or word), terms of REMOVE or more go. A word that is common elsewhere discloses nothing, and texts without an entity are
left alone.

Only entities, their surrounding terms and counts are shuffled, never texts. An entity in a third of all documents is
aggregated on the map side. Null and empty texts have no spans. Repeated rows are repeated in the result, each with its
own spans, and rows with a null or shared doc_id are treated like others: decisions are joined by the number of a row.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
WINDOW, CAUTION, GENERALISE, REMOVE = 8, 1.0, 0.8, 0.95
#: A term's least length, a secret's least length, and the least share of its neighbours that are a letter and a digit.
TERM_CHARS, SECRET_CHARS, CHANGES = 3, 20, 1 / 8
#: Terms that a task counts before it hands the counts on.
_COUNTED = 300_000

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: All that a number pattern can match lies in one such run.
_NUMBERS = re.compile(r"\+?[0-9][\x20().0-9-]*")
#: A number starts where its first run of digits starts.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_KEYS = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SECRET_CHARS)
_CHANGE = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")
_WORD = re.compile(r"[^\W_]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found["email"].append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for run in _NUMBERS.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            # The run may begin inside a longer pattern of digits only at its own start.
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                found["ip"].append(("ip", *m.span()))
        for m in _CARD.finditer(text, a, b):
            if 13 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
                found["card"].append(("card", *m.span()))
        if text[a] == "+" and (m := _PHONE.match(text, a, b)) and 9 <= len(_digits(m.group())) <= 15:
            found["phone"].append(("phone", *m.span()))
    return [s for k in KINDS for s in found[k]]


def secrets(text: str, base: list[Span]) -> list[Span]:
    """Runs of key characters in which letters and digits alternate, outside the base spans."""
    found = []
    for m in _KEYS.finditer(text):
        a, b = m.span()
        if len(_CHANGE.findall(m.group())) >= CHANGES * (b - a) and not any(x < b and a < y for _, x, y in base):
            found.append(("secret", a, b))
    return found


def entities(text: str, span: Span) -> tuple[str, str | None]:
    """The entity of a span and its coarser entity."""
    kind, a, b = span
    value = text[a:b] if kind == "secret" else text[a:b].lower() if kind in ("email", "ip") else _digits(text[a:b])
    coarse = {"email": value.rpartition("@")[2], "ip": ".".join(value.split(".")[:2]), "card": value[:6], "phone": value[:4]}.get(kind)
    return f"{kind}:{value}", None if coarse is None else f"{kind} group:{coarse}"


def neighbours(text: str, spans: list[Span], window: int = WINDOW) -> list[tuple[Span, str, int, int]]:
    """(span, term, start, end) of the terms among the window words on each side of each span; words in spans do not count."""
    taken = bytearray(len(text))
    for _, a, b in spans:
        taken[a:b] = b"\1" * (b - a)
    words = [m.span() for m in _WORD.finditer(text)]
    words = [(s, e) for s, e in words if not any(taken[s:e])]
    starts = [s for s, _ in words]
    out = []
    for span in spans:
        at = bisect_left(starts, span[1])
        for s, e in words[max(0, at - window) : at + window]:
            if e - s >= TERM_CHARS:
                out.append((span, text[s:e].lower(), s, e))
    return out


def _hash(text: str) -> int:
    raw = xxhash.xxh64_intdigest(text)
    return raw - (1 << 64) if raw >> 63 else raw


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
MARKED = f"doc_id bigint, text string, base {SPANS}, secrets {SPANS}, near array<struct<entity:bigint,coarse:bigint,term:bigint,start:bigint,end:bigint>>, entities array<bigint>, pairs array<struct<entity:bigint,term:bigint>>"
TERMS = "array<struct<start:bigint,end:bigint,disclosure:double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_NEAR = pa.struct([(n, pa.int64()) for n in ("entity", "coarse", "term", "start", "end")])
_PAIR = pa.struct([("entity", pa.int64()), ("term", pa.int64())])
_MARKED = [pa.string(), pa.list_(_SPAN), pa.list_(_SPAN), pa.list_(_NEAR), pa.list_(pa.int64()), pa.list_(_PAIR)]


def mark(text: str, window: int = WINDOW) -> tuple:
    """A text's row: itself if it has spans, base spans, secrets, neighbouring terms, distinct entities, distinct pairs of both."""
    base = base_spans(text)
    hidden = secrets(text, base)
    spans = base + hidden
    if not spans:
        return None, [], [], [], [], []
    names = {s: [None if e is None else _hash(e) for e in entities(text, s)] for s in spans}
    near = [(*names[s], _hash(t), a, b) for s, t, a, b in neighbours(text, spans, window)]
    held = sorted({e for both in names.values() for e in both if e is not None})
    pairs = sorted({(e, t) for own, coarse, t, _, _ in near for e in (own, coarse) if e is not None})
    as_rows = lambda found, names: [dict(zip(names, x)) for x in found]
    return text, as_rows(base, _SPAN.names), as_rows(hidden, _SPAN.names), as_rows(near, _NEAR.names), held, as_rows(pairs, _PAIR.names)


def _mark_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        rows = [mark(value.as_py() or "", window) for value in batch.column(1)]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), _MARKED)] if rows else [pa.array([], kind) for kind in _MARKED]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "text", "base", "secrets", "near", "entities", "pairs"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def part() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(map(_hash, counts), pa.int64()), pa.array(counts.values(), pa.int64())], ["term", "df"])

    for batch in batches:
        for value in batch.column(0):
            counts.update({w.lower() for w in set(_WORD.findall(value.as_py() or "")) if len(w) >= TERM_CHARS})
            if len(counts) > _COUNTED:
                yield part()
                counts.clear()
    if counts:
        yield part()


def lower_share(part: Column, whole: Column, caution: float) -> Column:
    """The lower Wilson bound of part / whole."""
    p, z2 = part / whole, F.lit(caution * caution)
    return (p + z2 / (2 * whole) - F.lit(caution) * F.sqrt(p * (1 - p) / whole + z2 / (4 * whole * whole))) / (1 + z2 / whole)


def disclosures(marked: DataFrame, texts: DataFrame, caution: float = CAUTION) -> DataFrame:
    """(entity, term, disclosure) of every pair that occurs; all counts are of rows."""
    held = marked.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("df_e"))
    pairs = marked.select(F.explode("pairs").alias("x")).select("x.*").groupBy("entity", "term").agg(F.count("*").alias("co"))
    pairs = common.stored(pairs.join(held, "entity"), "pairs")
    n = F.lit(float(max(marked.count(), 1)))
    counts = texts.mapInArrow(_count_batches, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df_t"))
    told = lower_share(F.col("co").cast("double"), F.greatest("df_t", "co").cast("double"), caution)
    content = F.log2(n / F.col("df_e"))
    return pairs.join(counts, "term").select("entity", "term", F.when(content > 0, F.log2(told * n / F.col("df_e")) / content).otherwise(F.lit(0.0)).alias("disclosure"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, caution: float = CAUTION, threshold: float = GENERALISE) -> DataFrame:
    """Per row: doc_id, text (null where nothing is found), base spans, secrets, and terms (start, end, disclosure) from the threshold on."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = rows.mapInArrow(lambda batches: _mark_batches(batches, window), MARKED)
    marked = common.stored(marked.withColumn("row", F.monotonically_increasing_id()), "marked")
    told = common.stored(disclosures(marked, rows.select("text"), caution).where(F.col("disclosure") >= threshold), "disclosures")
    near = marked.select("row", F.explode("near").alias("x")).select("row", "x.start", "x.end", "x.term", F.explode(F.array("x.entity", "x.coarse")).alias("entity")).where("entity is not null")
    spans = near.join(told, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    return marked.join(terms, "row", "left").select("doc_id", "text", "base", "secrets", F.coalesce("terms", F.array().cast(TERMS)).alias("terms"))


def clean(text: str, spans: list[Span], terms: list[tuple[int, int, float]], remove: float = REMOVE) -> str:
    """The text with its spans as [kind] and its telling terms as their class, or gone."""
    edits = [(a, b, f"[{k}]") for k, a, b in spans]
    for a, b, disclosure in terms:
        word = text[a:b]
        kind = "number" if any(c.isdigit() for c in word) else "name" if word[:1].isupper() else "word"
        edits.append((a, b, "" if disclosure >= remove else f"[{kind}]"))
    out, at = [], 0
    for a, b, new in sorted(edits):
        if a < at:  # inside the span before
            at = max(at, b)
            continue
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


def _clean_batches(batches: Iterator[pa.RecordBatch], remove: float) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, base, secrets, terms); a text becomes its clean form."""
    for batch in common.sliced(batches):
        texts = []
        for text, base, hidden, terms in zip(*(batch.column(c).to_pylist() for c in range(1, 5))):
            spans = [(s["kind"], s["start"], s["end"]) for s in base + hidden]
            texts.append(None if text is None else clean(text, spans, [(t["start"], t["end"], t["disclosure"]) for t in terms], remove))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *batch.columns[2:]], ["doc_id", "clean_text", "base", "secrets", "terms"])


CLEAN = f"doc_id bigint, clean_text string, base {SPANS}, secrets {SPANS}, terms {TERMS}"


def cleaned(found: DataFrame, remove: float = REMOVE) -> DataFrame:
    """What find() gives, with clean_text for text: null where nothing was found."""
    return found.select("doc_id", "text", "base", "secrets", "terms").mapInArrow(lambda batches: _clean_batches(batches, remove), CLEAN)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, caution: float = CAUTION, threshold: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, clean_text, base, secrets and terms per row. Texts without an entity are read once more, as they are; null ones become empty."""
    found = cleaned(find(docs, id_col, text_col, window, caution, threshold), remove).where("clean_text is not null")

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            plain = [not (base := base_spans(x)) and not secrets(x, base) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "clean_text"]).filter(pa.array(plain, pa.bool_()))

    others = common.map_batches(docs, [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")], untouched, "doc_id bigint, clean_text string")
    none = F.array().cast(SPANS)
    return found.unionByName(others.select("doc_id", "clean_text", none.alias("base"), none.alias("secrets"), F.array().cast(TERMS).alias("terms")))


def _equals(value: str):
    return lambda x: x == value


def op9_disclosure(spark, sf_dir: str) -> DataFrame:
    """The base columns; spans of all kinds; n_secret, n_term, private (any span); and the digest of the sanitised text, null where it stays as it is."""
    found = cleaned(find(common.table(spark, sf_dir, "documents")))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base, hidden = shown("base"), shown("secrets")
    terms = F.array_join(F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"])), ",")
    counts = [F.size(F.filter(F.transform("base", lambda s: s["kind"]), _equals(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", *[F.nullif(x, F.lit("")) for x in (base, hidden, terms)]).alias("spans"),
        F.size("secrets").cast("bigint").alias("n_secret"),
        F.size("terms").cast("bigint").alias("n_term"),
        (F.size("base") + F.size("secrets") > 0).alias("private"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )
