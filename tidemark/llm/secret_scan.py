"""Secrets in texts: three fixed patterns, and strings that a primed compressor finds new.

The patterns (assignments to sensitive names, access keys, long hexadecimal runs) are the base.
The novelty method adds strings that stand near a sensitive word: each candidate is compressed by
zstandard, primed with a dictionary of identifiers and long words, once with and once without its surroundings; its
marginal bytes per character tell how much of it neither the surroundings nor the dictionary
explain. Random keys, of letters or digits only too, cost about as many bytes as their entropy, known
identifiers and words far fewer; a long word the dictionary lacks is told as a key is.

Edge cases: a null text is an empty one (no spans); texts are scanned whole, however long;
repeated rows are scanned row by row; bytes of any language count as code points in spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx

#: The base patterns and the least length of what they must hold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16, "novel": 12}
KINDS = ("assign", "access", "hex", "novel")

#: Words that make the strings after them sensitive.
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key",
             "credential", "private_key", "private key", "bearer", "access key", "access_key")
_NEAR = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: What code says about secrets without holding one.
IDENTIFIERS = (
    "username password passwd user_password password_hash password_reset_token access_token "
    "refresh_token auth_token csrf_token session_token token_type expires_in client_id client_secret "
    "secret_key SECRET_KEY API_KEY api_key apiKey API_TOKEN private_key public_key credentials "
    "Authorization: Bearer Basic application/json Content-Type example changeme placeholder "
    "your_password_here your-api-key-here os.environ getenv config settings undefined null None "
    "AbstractAuthenticationProvider UserDetailsService PasswordEncoder getPassword setPassword "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ the and of to in for with "
)
#: Common long words, which the novelty would otherwise take for letters-only keys.
LONG_WORDS = (
    "accidentally accommodation accomplishment accountability acknowledgement additionally administration "
    "administrator advertisement agricultural alternatively announcement appropriately approximately "
    "architecture authentication authorization automatically availability characteristics championship "
    "circumstances collaboration communication comprehensive compatibility concentration configuration "
    "congratulations consciousness consequences considerable considerably consideration constitutional "
    "construction contemporary continuously contribution conventional conversation corresponding "
    "demonstration description determination development differentiate disappointment discrimination "
    "distribution documentation effectiveness electromagnetic encyclopedia enthusiastic entertainment "
    "entrepreneur environmental establishment experimental extraordinary fundamentally functionality "
    "governmental headquarters identification immediately implementation improvement independently "
    "individually industrialization infrastructure instantaneously institutional instructions instrumental "
    "intellectual intelligence international internationally interpretation investigation jurisdiction "
    "justification kindergarten knowledgeable legislation manufacturer manufacturing mathematical "
    "measurements mediterranean microprocessor misunderstanding modification multinational neighborhood "
    "nevertheless notification occasionally organizational organization-wide participants participation "
    "particularly pharmaceutical philosophical photographer predominantly presentation presidential "
    "professional psychological qualification questionnaire recommendation redistribution relationship "
    "representation representative requirements responsibility revolutionary satisfaction significantly "
    "simultaneously sophisticated specification straightforward subsequently successfully superintendent "
    "surprisingly sustainability technological telecommunications temporarily transformation transportation "
    "understanding unfortunately universities unprecedented verification vulnerability whatsoever "
    "wissenschaftlich selbstverständlich Geschwindigkeit Verantwortung Entwicklungen Informationen Unternehmen "
    "Gesellschaft Bundesrepublik Zusammenarbeit Voraussetzungen wahrscheinlich Veranstaltung Versicherung "
    "naturellement malheureusement particulièrement développement gouvernement environnement administration "
    "actuellement immédiatement responsabilité desafortunadamente aproximadamente responsabilidad "
    "especialmente administración desarrolladores conocimientos establecimiento inmediatamente "
)

REACH = 48  # code points from the sensitive word to the candidate's start, or back to its end
AROUND = 160  # code points of surroundings on either side
NOVEL = 0.55  # marginal bytes per character of the candidate


class Novelty:
    """Marginal compressed size of a string within its surroundings."""

    def __init__(self, known: str = LONG_WORDS + IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(known.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compress = zstandard.ZstdCompressor(
            level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def marginal(self, before: str, candidate: str, after: str) -> int:
        around = (before + "\n" + after).encode()
        return len(self.compress(around + b"\n" + candidate.encode())) - len(self.compress(around + b"\n"))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return found


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty: Novelty, least: float = NOVEL):
    """Strings near a sensitive word that are new to the compressor and not in a base span.

    Behind a word: those that start at most ``REACH`` after it, the rest of a string that holds the word
    included. In front of it: those that end at most ``REACH`` before it, as far as the word; what a span
    found behind a word covers is not told again.
    """
    words = [(m.start(), m.end()) for m in _NEAR.finditer(text)]
    if not words:
        return
    runs = [(m.start(), m.end()) for m in _STRING.finditer(text)]
    starts, ends = [s for s, _ in runs], [e for _, e in runs]
    behind, front = [], []
    for begin, end in words:
        k = bisect_right(ends, end)
        while k < len(runs) and starts[k] <= end + REACH:
            behind.append((max(starts[k], end), ends[k]))
            k += 1
        k = bisect_left(ends, begin - REACH)
        while k < len(runs) and starts[k] < begin:
            front.append((starts[k], min(ends[k], begin)))
            k += 1
    seen: set[tuple[int, int]] = set()
    told: list[tuple[int, int]] = []
    for i, (start, end) in enumerate(behind + front):
        if end - start < LEAST["novel"] or (start, end) in seen:
            continue
        seen.add((start, end))
        value = text[start:end]
        if any(s < end and start < e for s, e, _ in base):
            continue
        if i >= len(behind) and any(s < end and start < e for s, e in told):
            continue
        # A copy of the string nearby would explain it.
        before, after = (t.replace(value, " ") for t in (text[max(0, start - AROUND) : start], text[end : end + AROUND]))
        bytes_ = novelty.marginal(before, value, after)
        if bytes_ >= least * len(value):
            told.append((start, end))
            yield start, end, "novel"


def joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def _suspects(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Texts that may hold a span: with a sensitive word, ``AKIA`` or a long hexadecimal run."""
    flags = np.zeros(len(off) - 1, bool)
    small = np.zeros(256, bool)
    small[list(b"0123456789abcdef")] = True
    run = np.zeros(len(data) + 1, np.int32)
    np.cumsum(small[data], out=run[1:])
    size = LEAST["hex"]
    at = np.flatnonzero(run[size:] - run[:-size] == size) if len(data) >= size else np.zeros(0, int)
    flags[np.searchsorted(off, at, "right") - 1] = True
    raw = data.tobytes()
    places = []
    for source, words in ((raw, (b"AKIA",)), (raw.lower(), [w.encode() for w in SENSITIVE])):
        for word in words:
            at = source.find(word)
            while at >= 0:
                places.append(at)
                at = source.find(word, at + 1)
    flags[np.searchsorted(off, np.array(places, np.int64), "right") - 1] = True
    return flags


def scan(docs: DataFrame, least_novelty: float = NOVEL) -> DataFrame:
    """doc_id and ``found``: array of (kind, start, end, value) by start, then kind, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("value", pa.string())]))
        for batch, data, off in tx.sliced(batches):
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(_suspects(data, off)):
                text = batch.column(1)[int(i)].as_py() or ""
                spans = base_spans(text)
                spans += list(novel_spans(text, spans, novelty, least_novelty))
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                out[i] = [{"kind": k, "start": s, "end": e, "value": text[s:e]} for s, e, k in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(
        run, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint,value:string>>"
    )


def digest_of(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
