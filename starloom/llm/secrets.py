"""Secret scan: fixed credential patterns, plus strings that dictionary-primed zstandard finds novel.

A candidate is a long token soon after a word that speaks of credentials. Its marginal size is what zstandard needs for
it beyond an empty input, primed with a dictionary of common identifiers and the text around the candidate. Words,
paths and names that occur nearby shrink; a random key does not.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import bounded_batches

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ with 16 characters or more
CONTEXT_WORDS = (*ASSIGN_WORDS, "credential", "private_key", "private key", "access_key", "access key", "bearer", "authorization")
CONTEXT = re.compile("|".join(map(re.escape, CONTEXT_WORDS)), re.IGNORECASE | re.ASCII)
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
IDENTIFIERS = (
    "access account address admin api application authorization auth base bearer bucket cache certificate class client "
    "code com config connection content context cookie credential data database date default description development "
    "digest document email encode encryption endpoint env environment error example expires false file format function "
    "get handler hash header host html http https id import index info input integer interface json key length library "
    "list local localhost login manager message method model module name null number object option org output package "
    "parameter password path placeholder port private production property protocol provider public query read region "
    "release request response result return role root sample schema secret security self server service session setting "
    "signature source static status storage string super system table template test text time timestamp token true type "
    "undefined update url user username utf value variable version void web write xml your_api_key your_password_here"
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in code points."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(spans, key=lambda x: (x[0], x[2]))]


def novelty(candidate: str, around: str, identifiers: str = IDENTIFIERS, piece: int = 32) -> float:
    """Marginal compressed bytes of the candidate, per byte, primed with the identifiers and the text around it.

    Long candidates are measured in pieces: beyond some 35 bytes zstandard codes the letters themselves by frequency,
    which would measure the alphabet instead of what is known. Other copies of the candidate do not count as context;
    `surroundings` leaves out those that lie only partly within it.
    """
    primer = zstandard.ZstdCompressionDict(
        f"{identifiers} {around.replace(candidate, ' ')}".encode("utf-8", "surrogatepass"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    press = zstandard.ZstdCompressor(level=12, dict_data=primer)
    raw = candidate.encode("utf-8", "surrogatepass")
    n = max(1, -(-len(raw) // piece))
    cuts = [len(raw) * i // n for i in range(n + 1)]
    bare = len(press.compress(b""))
    return sum(len(press.compress(raw[x:y])) - bare for x, y in zip(cuts, cuts[1:])) / max(1, len(raw))


def kind_changes(s: str) -> int:
    """How often a capital, a small letter and a digit stand next to one of another kind."""
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 for c in s if c.isalnum()]
    return sum(x != y for x, y in zip(kinds, kinds[1:]))


def surroundings(text: str, start: int, end: int, around: int) -> str:
    """`around` characters before and behind a candidate, without copies of it; copies are looked for beyond them too."""
    cand, n = text[start:end], end - start
    before = text[max(0, start - around - n) : start].replace(cand, " ")
    return before[-around:] + text[end : end + around + n].replace(cand, " ")[:around]


def novel_spans(
    text: str, taken: list[tuple[int, int, str]], reach: int = 48, around: int = 400, at_least: float = 0.95, changes: int = 3
) -> list[tuple[int, int, str]]:
    """Incompressible tokens that start within `reach` characters after a credential word and lie in no taken span.

    A token that the credential word is itself a part of counts from behind its last one. Tokens with fewer than
    `changes` changes between digits, capitals and small letters are words or names.
    """
    ends = [m.end() for m in CONTEXT.finditer(text)]
    if not ends:
        return []
    starts, stops = [x for x, _, _ in taken], list(accumulate((y for _, y, _ in taken), max))
    found = []
    for m in TOKEN.finditer(text):
        s, e = m.span()
        i = bisect_right(ends, e - 1)
        if i and ends[i - 1] > s:  # the last credential word that ends within the token
            s = ends[i - 1]
            s += len(text[s:e]) - len(text[s:e].lstrip("=/+_.-"))
            if e - s < 16:
                continue
        elif not i or s > ends[i - 1] + reach:
            continue
        j = bisect_right(starts, s)
        if j and stops[j - 1] >= e:
            continue  # a fixed pattern holds all of it
        cand = text[s:e]
        if kind_changes(cand) >= changes and novelty(cand, surroundings(text, s, e, around)) >= at_least:
            found.append((s, e, "novel"))
    return found


def all_spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans, and all spans, of a whole text."""
    base = base_spans(text or "")
    every = sorted(base + novel_spans(text or "", base), key=lambda x: (x[0], KINDS.index(x[2])))
    return base, every


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str | None, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans, redacted (and keep) for every row of docs.

    Whole texts are scanned row by row; null and empty texts have no spans, a null text stays null when redacted; null
    ids and repeated rows pass through; an empty table gives an empty result; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [all_spans(t) for t in texts]
            count = {k: [sum(s[2] == k for s in every) for _, every in found] for k in KINDS}
            lines = [joined(base) for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *(pa.array(count[k], pa.int64()) for k in KINDS),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines], pa.string()),
                    pa.array([joined(every) for _, every in found], pa.string()),
                    pa.array([redacted(t, every) for t, (_, every) in zip(texts, found)], pa.string()),
                    *b.columns[2:],
                ],
                names,
            )

    carried = [F.col(c).alias(f"_keep_{c}") for c in keep or []]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"), *carried)
    schema = T.StructType(
        [
            src.schema.fields[0],
            *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
            *(T.StructField(n, T.StringType()) for n in ("base_sha256", "spans", "redacted")),
            *src.schema.fields[2:],
        ]
    )
    names = schema.names
    out = bounded_batches(src).mapInArrow(run, schema)
    return out.select(*names[:8], *[F.col(f"_keep_{c}").alias(c) for c in keep or []])
