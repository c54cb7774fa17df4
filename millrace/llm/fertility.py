"""Quality rules from tokenizer fertility, on top of plain counting rules.

Public vocabularies tokenize each whole text: one of pieces with byte fallback, one of byte pairs for many languages. Characters per
token, the share of tokens that are single bytes of a longer character, and the entropy of the tokens must lie in bands, for both: the
fixed bands of the text's script, which only foreign matter leaves, and bands learned from all texts of the same language (the script,
where none is given) and of about the same number of tokens. Those reach FENCE times the distance of the quartiles beyond them, so
that texts whose words split unlike the rest of their language fall out whatever the language is.
"""

import base64
import re
import unicodedata
from functools import partial
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import small_side, stored
from .common import table
from .hashing import window_hashes, word_hashes

_SPACES, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"
REPEAT_WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30

# For each script the least and most characters per token, the largest share of byte-fallback tokens, and the least
# entropy in bits per token of a text of at least MIN_TOKENS tokens. They hold for both vocabularies.
MIN_TOKENS = 100
BANDS = {
    "latin": (1.2, 8.0, 0.12, 4.5),
    "cyrillic": (0.9, 6.0, 0.15, 4.0),
    "greek": (0.7, 4.0, 0.15, 4.0),
    "arabic": (0.7, 4.0, 0.20, 4.0),
    "cjk": (0.25, 3.0, 0.90, 4.0),
    "other": (0.25, 8.0, 0.95, 3.5),
    "none": (inf, 0.0, 0.0, inf),
}
#: Learned bands: how far they reach beyond the quartiles, in distances of the quartiles, and how many texts a group must have.
FENCE, MIN_GROUP = 3.0, 30
#: What has a learned band: below and above, or below only (a text is never too varied). Values are rounded to so many places.
LEARNED, PLACES = {"chars_per_token": True, "chars_per_pair": True, "token_entropy": False, "pair_entropy": False}, 3
#: Texts above so many characters are tokenized in pieces, cut at a space between two letters, where both vocabularies cut anyway.
PIECE_CHARS = 1 << 20
_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
_SCRIPTS = {"LATIN": "latin", "CYRILLIC": "cyrillic", "GREEK": "greek", "ARABIC": "arabic", "CJK": "cjk", "HIRAGANA": "cjk", "KATAKANA": "cjk", "HANGUL": "cjk"}
_KNOWN: dict[str, str | None] = {}
#: Bands that are broadcast at most; more are joined by shuffle.
MAX_BROADCAST_ROWS = 100_000


def _script_of(c: str) -> str | None:
    if c not in _KNOWN:
        _KNOWN[c] = _SCRIPTS.get(unicodedata.name(c, "?").split()[0].split("-")[0], "other") if c.isalpha() else None
    return _KNOWN[c]


def script(text: str) -> str:
    """The script of most letters; none without letters."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "none"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    chars, counts = np.unique(codes, return_counts=True)
    total: dict[str, int] = {}
    for c, n in zip(chars.tolist(), counts.tolist(), strict=True):
        if s := _script_of(chr(c)):
            total[s] = total.get(s, 0) + n
    return max(sorted(total), key=total.get) if total else "none"


def counting_rules(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    word_chars = len(text) - (len(data) - len(data.translate(None, _SPACES)))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    h = word_hashes(data)
    seen: set[str] = set()
    dup = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup += bool(line.strip(" \t\n\r\x0b\x0c"))
            else:
                seen.add(line)
    repeated = 0
    w = window_hashes(h, REPEAT_WINDOW)
    ranked = np.sort(w)
    if (ranked[1:] == ranked[:-1]).any():
        order = np.argsort(w)
        same = ranked[1:] == ranked[:-1]
        at = np.unique(np.r_[order[1:][same], order[:-1][same]])
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + REPEAT_WINDOW, -1)
        repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    return len(h), word_chars, symbols, dup, repeated


class PieceVocabulary:
    """A sentencepiece model, given as its bytes."""

    spaced = False

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte = np.array([self.sp.is_byte(i) for i in range(self.sp.get_piece_size())])

    def ids(self, text: str) -> np.ndarray:
        return self.sp.encode_as_numpy(text)


class PairVocabulary:
    """Byte pairs as a list of base64 tokens and ranks, given as its bytes, and the pattern that splits texts."""

    spaced = True

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tokens, special_tokens={})
        self.byte = np.zeros(max(tokens.values()) + 1, bool)
        self.byte[[r for t, r in tokens.items() if len(t) == 1 and t[0] > 127]] = True

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())


def text_pieces(text: str, spaced: bool):
    """Parts of a long text; the space at a cut goes to the part after it if spaced, else to none. A text without such a space is whole."""
    start = 0
    while len(text) - start > PIECE_CHARS and (m := _CUT.search(text, start + PIECE_CHARS)):
        yield text[start : m.start()]
        start = m.start() if spaced else m.end()
    yield text[start:]


def fertility(vocabulary, text: str) -> tuple[int, float, float, float]:
    """(tokens, characters per token, byte-fallback share, entropy in bits per token)."""
    ids = [vocabulary.ids(p) for p in text_pieces(text, vocabulary.spaced)]
    ids = ids[0] if len(ids) == 1 else np.concatenate(ids)
    if not len(ids):
        return 0, 0.0, 0.0, 0.0
    if len(ids) < 8000:  # shorter than the vocabulary: sorting costs less than counting by id
        own = np.sort(ids)
        counts = np.diff(np.flatnonzero(np.r_[True, own[1:] != own[:-1], True]))
    else:
        counts = np.bincount(ids)
        counts = counts[counts > 0]
    entropy = float(np.log2(len(ids)) - (counts * np.log2(counts)).sum() / len(ids))
    return len(ids), len(text) / len(ids), float(vocabulary.byte[ids].mean()), entropy


def verdict(kind: str, tokens: int, chars_per_token: float, fallback: float, entropy: float) -> bool:
    low, high, most_bytes, least_bits = BANDS[kind]
    return low <= chars_per_token <= high and fallback <= most_bytes and (tokens < MIN_TOKENS or entropy >= least_bits)


_OUT = "doc_id long, language string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, in_script boolean, script string, n_tokens long, chars_per_token double, fallback_share double, token_entropy double, n_pair_tokens long, chars_per_pair double, pair_fallback_share double, pair_entropy double"


def _rules(batches, files):
    vocabularies = None
    for batch in batches:
        vocabularies = vocabularies or (PieceVocabulary(files.value[0]), PairVocabulary(*files.value[1:]))
        rows = []
        for text in batch.column(1):
            text = text.as_py() or ""
            counts = counting_rules(text)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
            kind, stats = script(text), [fertility(v, text) for v in vocabularies]
            rows.append((*counts, failed, all(verdict(kind, *x) for x in stats), kind, *stats[0], *stats[1]))
        columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=[x.split()[0] for x in _OUT.split(", ")])


def learned_bands(stats: DataFrame) -> DataFrame:
    """(grp, size, and low_x, high_x of each learned value) of the groups of at least MIN_GROUP texts that pass the base rules. Quartiles
    are exact over rounded values, of which a group has a bounded number, and are combined before the shuffle."""
    columns = [F.round(c, PLACES).alias(c) for c in LEARNED]
    found = stats.where("not base_failed").select("grp", "size", *columns).groupBy("grp", "size").agg(F.count("*").alias("n"), *(F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).alias(c) for c in LEARNED))
    bounds = []
    for c, both in LEARNED.items():
        low, high = F.get(c, F.lit(0)), F.get(c, F.lit(1))
        bounds += [(low - FENCE * (high - low)).alias(f"low_{c}"), (high + FENCE * (high - low)).alias(f"high_{c}") if both else F.lit(inf).alias(f"high_{c}")]
    return found.where(F.col("n") >= MIN_GROUP).select("grp", "size", *bounds)


def quality_rules(docs: DataFrame, pieces_path: str | None = None, pairs_path: str | None = None, pattern: str | None = None, language: str | None = None) -> DataFrame:
    """Counting rules and fertility bands for every row. pieces_path is a sentencepiece model, pairs_path a list of byte pairs with its
    pattern (default: the public ones that the module public_tokenizers finds, where it is installed). language: a column of docs that
    names the language; texts without one are grouped by script.

    Null and empty texts count 0 words and fail the base rule. A text without letters is in no script's band; of scripts with as many
    letters, the first by name counts. A long text counts whole. One row per input row, repeated ones alike; an empty table gives none.
    Extra columns are ignored."""
    if not (pieces_path and pairs_path and pattern):
        import public_tokenizers as public

        pieces_path, pairs_path = pieces_path or public.path("piece_bpe_32k.model"), pairs_path or public.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public.PATTERN
    with open(pieces_path, "rb") as a, open(pairs_path, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read(), pattern))
    named = (F.col(language) if language else F.lit(None)).cast("string").alias("language")
    stats = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", named).mapInArrow(partial(_rules, files=files), _OUT)
    group = F.coalesce(F.concat(F.lit("language "), F.col("language")), F.concat(F.lit("script "), F.col("script")))
    stats = stored(stats.withColumns({"grp": group, "size": F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")}))
    inside = F.col("in_script")
    for c in LEARNED:
        inside = inside & F.coalesce(F.round(c, PLACES).between(F.col(f"low_{c}"), F.col(f"high_{c}")), F.lit(True))
    bands = small_side(stored(learned_bands(stats)), MAX_BROADCAST_ROWS)
    return stats.join(bands, ["grp", "size"], "left").select(*stats.columns, (~F.col("base_failed") & inside).alias("kept")).drop("grp", "size", "in_script")


def op9_fertility(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), language="lang").drop("language")
