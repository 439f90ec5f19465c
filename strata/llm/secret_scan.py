"""Secrets: three patterns, and strings that a primed compressor can't shorten.

Pattern spans (leftmost, not overlapping within a kind, whole match):

* assign: a password, secret, token or API key set to 6 characters or more
* access: ``AKIA`` and capitals or digits, 20 characters or more
* hex: lower-case hexadecimal, 24 characters or more

Novelty spans: candidates are runs of 16 or more key characters that begin within
CONTEXT characters after a sensitive word, and runs that directly follow one which was
reported (the next line of a key), however many there are. A candidate is compressed by
zstandard, primed with a dictionary of common identifiers and the text around it. Text
that repeats its surroundings or is built of known identifiers costs few bytes more; a
run is reported as ``novel`` when it costs about what random characters of its own
alphabet do (a hexadecimal digit is worth half a byte, a letter or digit three quarters),
unless a pattern span already covers part of it. Runs of letters alone must also be
unlike words, by the share of their pairs of neighbouring letters that are common in
them: a word that is new here is incompressible, too.

Spans count code points, end exclusive. Cases: null or empty text has no spans;
texts are scanned whole, however long, in time linear in their length; repeated rows are scanned alike; an
empty table gives an empty result; other columns pass through ``masked``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strata.llm.tables import free_name

KINDS = ["assign", "access", "hex", "novel"]
CONTEXT = 64
SURROUNDINGS = 2048
NOVELTY = 0.7  # bytes a character; random letters and digits take 0.74, however long
SHARE = 0.95  # of the entropy of an alphabet smaller than letters and digits
BETWEEN = 16  # most characters between two lines of a key: line end, quotes, indent, +
WORD_LIKE = 0.35  # share of common pairs; chance gives 0.2, words of European languages over 0.4
MIXED_LIKE = 0.5  # the same where case changes as in MIXED of all pairs: chance gives 0.5 there
MIXED = 0.25
# Common pairs of letters in words.
COMMON_PAIRS = frozenset(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le "
    "ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec "
    "pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na "
    "ni ts mo ow im mi sh ir os ia am ci op sc ei do da au".split()
)
LEVEL = 9
# Identifiers that surround or resemble secrets without being any.
IDENTIFIERS = (
    "access_token access_key accesskeyid account administrator algorithm apikey application "
    "authenticate authentication authorization backend base64 bearer certificate checksum "
    "cipher client_id client_secret commit config configuration connection container cookie "
    "credentials database default deploy description development digest document encrypted "
    "endpoint environment example function generate github hash header hostname identifier "
    "import instance integer keystore latest length localhost management master message "
    "metadata namespace object openssl organization package parameter passphrase password "
    "permission placeholder postgres private production property protocol provider public_key "
    "redirect refresh_token region repository request resource response return revision role "
    "schema secret_key secretkey security server service session_id sha256 signature staging "
    "storage string subscription template tenant timestamp transaction undefined username "
    "utf-8 validate variable version workspace abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 xxxxxxxxxxxxxxxx 0000000000000000"
).encode()

ASSIGN = re.compile(
    "(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
CUES = ("auth", "bearer", "cred", "key", "passw", "private", "pwd", "secret", "session", "signature", "token")
CUE = re.compile("|".join(CUES), re.ASCII | re.IGNORECASE)
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
RUN_START = re.compile(r"[A-Za-z0-9+/_=-]{16}")
HAS_DIGIT = re.compile("[0-9]")
DIGITS_ONLY, HEX_LOWER, HEX_UPPER, BASE36_LOWER, BASE36_UPPER = map(
    re.compile, ("[0-9]+", "[0-9a-f]+", "[0-9A-F]+", "[0-9a-z]+", "[0-9A-Z]+")
)

SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
)


def pattern_spans(text: str, lower: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern kinds."""
    found = []
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def marginal_bytes(run: str, around: str) -> int:
    """Bytes that ``run`` adds to a zstandard frame primed with its surroundings
    (nearest bytes last, where matches are cheapest) and the identifiers."""
    primer = zstandard.ZstdCompressionDict(
        IDENTIFIERS + b" " + around.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=primer, write_content_size=False, write_checksum=False)
    return len(press.compress(run.encode())) - len(press.compress(b""))


def key_bytes(run: str) -> float:
    """Bytes a character that a random run of this run's alphabet takes at least."""
    body = run.strip("=-")
    classes = ((DIGITS_ONLY, 10), (HEX_LOWER, 16), (HEX_UPPER, 16), (BASE36_LOWER, 36), (BASE36_UPPER, 36))
    size = next((n for pattern, n in classes if pattern.fullmatch(body)), 64)
    return min(NOVELTY, SHARE * math.log2(size) / 8)


def random_letters(run: str) -> bool:
    """Whether a run without digits is unlike words, however new."""
    letters = "".join(c for c in run if c.isalpha())
    pairs = len(letters) - 1
    if pairs < 15:
        return False
    changes = sum(a.islower() != b.islower() for a, b in zip(letters, letters[1:], strict=False))
    letters = letters.lower()
    common = sum(letters[i : i + 2] in COMMON_PAIRS for i in range(pairs))
    return common < (MIXED_LIKE if changes > MIXED * pairs else WORD_LIKE) * pairs


def novel(text: str, start: int, end: int) -> bool:
    """Whether the candidate stays incompressible beside its surroundings."""
    run = text[start:end]
    if not (HAS_DIGIT.search(run) or random_letters(run)):
        return False
    around = text[end : end + SURROUNDINGS] + " " + text[max(0, start - SURROUNDINGS) : start]
    return marginal_bytes(run, around) >= key_bytes(run) * len(run)


def novel_spans(text: str, lower: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that stay incompressible and touch no known span."""
    found: list[tuple[int, int, int]] = []
    if not any(c in lower for c in CUES):
        return found
    covered: list[list[int]] = []  # known spans, overlapping ones as one, ascending
    for s, _, e in sorted(known):
        if covered and s < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    starts = [s for s, _ in covered]
    done = 0

    def touches(start: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return at > 0 and covered[at - 1][1] > start

    for cue in CUE.finditer(text):
        at, limit = max(done, cue.end()), cue.end() + CONTEXT
        while at <= limit and (m := RUN_START.search(text, at, limit + 16)):
            start = m.start()
            if start > limit:
                break
            end = done = at = RUN.match(text, start).end()
            if touches(start, end):
                limit = max(limit, end + BETWEEN)  # a key's first line may be a pattern's
            elif novel(text, start, end):
                found.append((start, 3, end))
                limit = max(limit, end + BETWEEN)
    return found


def text_spans(text: str | None) -> list[tuple[int, int, int]]:
    """All spans of one text, by start and then kind."""
    if not text:
        return []
    lower = text.lower()
    base = pattern_spans(text, lower)
    return sorted(base + novel_spans(text, lower, base))


@F.pandas_udf(SPANS)
def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in text_spans(t)] for t in texts], dtype=object)


@F.pandas_udf(StringType())
def _masked(texts: pd.Series) -> pd.Series:
    return pd.Series([mask(t) for t in texts], dtype=object)


def mask(text: str | None) -> str | None:
    """text with each stretch of overlapping spans replaced by ``[REDACTED]``."""
    spans = text_spans(text)
    if not spans:
        return text
    out, done, end = [], 0, -1
    for s, _, e in spans:
        if s >= end:
            out += [text[done:s], "[REDACTED]"]
        end = done = max(end, e)
    return "".join(out) + text[done:]


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): one row per document."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), _spans(F.col(f"`{text_col}`").cast("string")).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, the hash of the pattern spans, and all spans as text."""
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return secret_spans(docs, id_col, text_col).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] != "novel")).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def masked(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs with every span replaced, and the character count (if there) brought
    up to date where a text changed; same columns."""
    new = free_name(docs.columns, "masked")
    out = docs.withColumn(new, _masked(F.col(f"`{text_col}`")))
    clean = out[new].eqNullSafe(out[f"`{text_col}`"])
    value = {text_col: F.col(new)}
    if chars_col in docs.columns:
        old = F.col(f"`{chars_col}`")
        value[chars_col] = F.when(clean, old).otherwise(F.length(new)).cast(docs.schema[chars_col].dataType)
    return out.select(*[(value[c] if c in value else F.col(f"`{c}`")).alias(c) for c in docs.columns])
