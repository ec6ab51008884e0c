"""Statistics of each document's text and fixed-threshold rules that tell prose from lists, tables and junk.

Statistics are made for many texts at once, on the code points of a whole slice of a batch and with the engine's vectorised
text functions; no function runs for each text or word.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from lotline.session import ship

# Marks that open an entry of a list, ends of a sentence and what may close after them.
_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BULLET = r"^[<<]*(?:[-*+•·▪◦‣–—>]+|\[[ xX✓]?\]|\(?[0-9]{1,3}[.):]|\(?[a-zA-Z][.)])[<<]".replace("<<", _WS)
INLINE_BULLET = r"[<<;|,/](?:[-*+•·▪◦‣]|\[[ xX✓]?\]|\([0-9]{1,3}\)|[0-9]{1,3}[.)])[<<]".replace("<<", _WS)
SENTENCE_ENDS = r"[.!?…][\"'”’»)\]]*(?:[<<]|$)|[。！？]".replace("<<", _WS)
SEPARATOR = r"[<<][|>»/•·–—-][<<]".replace("<<", _WS)
GAP = r"[^<<] {2,}[^<<]".replace("<<", _WS)
MARKUP = r"</?[a-zA-Z][^<>]*>|&[a-z]{2,6};|\{[^{}]*\}"
MOJIBAKE = "[\u0080-\u009fÃÂÐÑâ-éï\ufffd][\u0080-¿\ufffd‘-„†-‰€ŠšŒœŽžƒˆ˜]"
ENDS, CLOSERS = ".!?…。！？", "\"'”’»)]"
PLAIN_SIGNS = ".,;:!?'\"()¿¡。，！？、；：“”‘’«»-"
DELIMITERS = {"pipe": "|", "tab": "\t", "semi": ";", "comma": ","}
COUNTS = ["n_lines", "n_words", "n_tokens_ws", "n_solid", "longest_token", "inline_bullets", "separators", "sentence_ends", "common_words", "distinct_common", "han_common", "hans", *[f"{d}_fields" for d in DELIMITERS]]
SHARES = [
    "letter_share", "digit_share", "symbol_share", "han_share", "mojibake_share", "replacement_share", "tag_share", "mean_word_length", "mean_line_words", "mean_token", "ended_line_share", "bullet_line_share", "short_line_share",
    "gapped_line_share", "ellipsis_line_share", "brief_line_share", "alphabetic_share", "hash_ellipsis_ratio", "distinct_word_share", "common_share", "han_common_share", *[f"{d}_regular" for d in DELIMITERS],
]
#: Code points handled at a time; a longer text makes a slice of its own.
SLICE_CHARS = 1_000_000


def common_words(words: DataFrame) -> tuple[list[str], list[str]]:
    """(words of spaced scripts, single characters of unspaced ones) of the common-word list, lower case.

    The list is a parameter of the job, as a vocabulary is, and goes to every task.
    """
    rows = words.select(F.lower("word").alias("w")).where("w is not null").distinct().collect()
    both = sorted(r.w for r in rows)
    han = [w for w in both if len(w) == 1 and "㐀" <= w <= "鿿"]
    return [w for w in both if w not in set(han)], han


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """For each code point: 0 white space, 1 letter, 2 digit, 3 plain sign or mark, 4 symbol; +8 for Han, +16 for replacement and control."""
    table = np.full(0x110000, 4, np.uint8)
    for c in range(0x110000):
        if 0x3400 <= c <= 0x9FFF:
            table[c] = 1 | 8
            continue
        if 0x20000 <= c <= 0x3FFFF or 0xAC00 <= c <= 0xD7A3:
            table[c] = 1
            continue
        if 0xE000 <= c <= 0xF8FF or c >= 0x40000:
            continue
        kind = unicodedata.category(chr(c))[0]
        if chr(c).isspace():
            table[c] = 0
        elif kind == "L":
            table[c] = 1
        elif 48 <= c <= 57:
            table[c] = 2
        elif kind in "MN" or chr(c) in PLAIN_SIGNS:
            table[c] = 3
    table[0xFFFD] = 4 | 16
    table[:9] |= 16
    return table


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    """Whether words are made of a code point: letters, and numbers that are no decimal digits."""
    table = np.zeros(0x110000, bool)
    for c in range(0x40000):
        ch = chr(c)
        table[c] = ch.isalnum() and not ch.isdecimal()
    return table


def _most(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.maximum.at(out, owner, values)
    return out


def _regular(counts: np.ndarray, owner: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the fields of its middle line by number of marks, and the share of lines with as many (0 for no mark)."""
    some = n_lines > 0
    first = np.cumsum(n_lines) - n_lines
    mid = np.zeros(len(n_lines), np.int64)
    mid[some] = counts[np.lexsort((counts, owner))][(first + n_lines // 2)[some]]
    same = np.bincount(owner, counts == mid[owner], len(n_lines))
    return mid + 1, np.where(some & (mid > 0), same / np.maximum(n_lines, 1), 0.0)


def describe(texts: pa.Array, words: frozenset[str], han: frozenset[str]) -> list[np.ndarray]:
    """COUNTS, then SHARES, of whole texts; NULL, empty and blank texts give zeros (fields: one)."""
    n = len(texts)
    t = pc.fill_null(texts.cast(pa.large_string()), "")
    for end in ("\r\n", "\r", "\u2028"):
        t = pc.replace_substring(t, end, "\n")
    offsets = np.r_[0, np.cumsum(pc.utf8_length(t).to_numpy())].astype(np.int64)
    code = np.frombuffer("".join(t.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[code]
    base = kind & 7
    doc = np.repeat(np.arange(n) * 32, np.diff(offsets))
    hist = np.bincount(doc + kind, minlength=32 * n).reshape(n, 32)
    solid = hist.sum(1) - hist[:, 0] - hist[:, 16]
    letters, hans, digits = hist[:, 1] + hist[:, 9], hist[:, 9], hist[:, 2]
    symbols, replaced = hist[:, 4] + hist[:, 20], hist[:, 16:].sum(1)

    # tokens between white space; a text's first character opens one
    opens = base != 0
    space = ~opens
    starts_doc = np.zeros(len(code) + 1, bool)
    starts_doc[offsets[:-1][offsets[:-1] < len(code)]] = True
    before = np.r_[True, space[:-1]] | starts_doc[: len(code)] if len(code) else np.empty(0, bool)
    after = np.r_[space[1:], True] | starts_doc[1:] if len(code) else np.empty(0, bool)
    token_at, token_end = np.flatnonzero(opens & before), np.flatnonzero(opens & after)
    owner_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    token_doc = owner_of(token_at)
    n_tokens = np.bincount(token_doc, minlength=n)
    longest = _most(token_end - token_at + 1, token_doc, n)
    alphabetic = np.bincount(token_doc, np.logical_or.reduceat(base == 1, token_at) if len(token_at) else None, n)

    # lines with something on them
    listed = pc.split_pattern(t, "\n")
    lines, line_doc = pc.list_flatten(listed), pc.list_parent_indices(listed).to_numpy()
    line_len = pc.utf8_length(lines).to_numpy()
    within = np.cumsum(line_len + 1) - (line_len + 1) - line_doc  # a text's line ends are counted with its characters, but for the last
    line_to = np.searchsorted(token_at, within + line_len)
    width = line_to - np.searchsorted(token_at, within)
    full = width > 0
    lines, line_doc, line_at, line_len, width, line_to = lines.filter(pa.array(full)), line_doc[full], within[full], line_len[full], width[full], line_to[full]
    n_lines = np.bincount(line_doc, minlength=n)
    by_line = lambda mask: np.bincount(line_doc, mask, n)
    regex = lambda pattern: pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
    # the last character of each line that isn't white space, then back over what closes
    last = token_end[line_to - 1]
    ellipsis = (code[last] == 0x2026) | ((code[last] == 46) & (last >= line_at + 2) & (code[np.maximum(last - 1, 0)] == 46) & (code[np.maximum(last - 2, 0)] == 46))
    closers, ends = np.array([ord(c) for c in CLOSERS], np.uint32), np.array([ord(c) for c in ENDS], np.uint32)
    live = np.isin(code[last], closers) & (last > line_at)
    while live.any():
        last = np.where(live, last - 1, last)
        live &= np.isin(code[last], closers) & (last > line_at)
    ended = np.isin(code[last], ends)
    marks = {d: _regular(pc.count_substring(lines, m).to_numpy(), line_doc, n_lines) for d, m in DELIMITERS.items()}

    # words: letters, and apostrophes between letters
    low = pc.utf8_lower(t)
    lower = np.frombuffer("".join(low.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    low_offsets = np.r_[0, np.cumsum(pc.utf8_length(low).to_numpy())].astype(np.int64)
    word = _word_table()[lower]
    apostrophe = (lower == 39) | (lower == 0x2019)
    inner = apostrophe & np.r_[False, word[:-1]] & np.r_[word[1:], False] if len(lower) else word
    edge = np.zeros(len(lower) + 1, bool)
    edge[low_offsets] = True
    inner &= ~edge[: len(lower)] & ~edge[1:]
    word = word | inner
    first = word & (np.r_[True, ~word[:-1]] | edge[: len(lower)]) if len(lower) else word
    # a blank before each word keeps words of neighbouring texts apart
    masked = np.where(word, lower, 32).astype(np.uint32)
    at = np.flatnonzero(first)
    spelled = np.insert(masked, at, 32).tobytes().decode("utf-32-le", "surrogatepass").split(" ") if len(at) else []
    found = pa.array([w for w in spelled if w], pa.large_string())
    word_doc = np.searchsorted(low_offsets, at, "right") - 1
    n_words = np.bincount(word_doc, minlength=n)
    word_chars = np.bincount(np.repeat(np.arange(n), np.diff(low_offsets))[word], minlength=n)
    coded = found.dictionary_encode()
    codes, known = coded.indices.to_numpy(), np.array([w in words for w in coded.dictionary.to_pylist()], bool)
    common = known[codes] if len(codes) else np.empty(0, bool)
    pairs = np.unique(word_doc * max(1, len(known)) + codes)
    pair_doc, pair_code = pairs // max(1, len(known)), pairs % max(1, len(known))
    distinct = np.bincount(pair_doc, minlength=n)
    n_common = np.bincount(word_doc, common, n)
    distinct_common = np.bincount(pair_doc, known[pair_code], n) if len(pairs) else np.zeros(n)
    of = lambda mask: np.bincount(doc[mask] >> 5, minlength=n)
    han_common = of(np.isin(code, np.array(sorted(map(ord, han)), np.uint32))) if han and hans.any() else np.zeros(n, np.int64)

    # markup: what is lost without it
    tag = np.zeros(n)
    some = np.flatnonzero(pc.match_substring_regex(t, "[<&{]").to_numpy(zero_copy_only=False))
    if some.size:
        bare = pc.replace_substring_regex(t.take(pa.array(some)), MARKUP, "")
        left = _classes()[np.frombuffer("".join(bare.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)]
        owner = np.repeat(np.arange(some.size), pc.utf8_length(bare).to_numpy())
        tag[some] = solid[some] - np.bincount(owner[(left != 0) & (left != 16)], minlength=some.size)
    count = lambda pattern: pc.count_substring_regex(t, pattern).to_numpy()
    share = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    hashes = of((code == 35) | (code == 0x2026)) + pc.count_substring(t, "...").to_numpy()
    counts = [n_lines, n_words, n_tokens, solid, longest, pc.count_substring_regex(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), t, pa.scalar("", pa.large_string())), INLINE_BULLET).to_numpy(), count(SEPARATOR), count(SENTENCE_ENDS), n_common, distinct_common, han_common, hans, *[m[0] for m in marks.values()]]
    shares = [
        share(letters, solid), share(digits, solid), share(symbols, solid), share(hans, solid), share(count(MOJIBAKE), solid), share(replaced, solid), share(tag, solid),
        share(word_chars, n_words), share(n_tokens, n_lines), share(solid, n_tokens), share(by_line(ended), n_lines), share(by_line(regex(BULLET)), n_lines), share(by_line(width <= 9), n_lines),
        share(by_line(regex(GAP)), n_lines), share(by_line(ellipsis), n_lines), share(by_line(line_len < 30), n_lines), share(alphabetic, n_tokens), share(hashes, n_tokens), share(distinct, n_words), share(n_common, n_words), share(han_common, hans), *[m[1] for m in marks.values()],
    ]
    blank = n_tokens == 0
    out = [np.where(blank, 1 if c.endswith("_fields") else 0, v) for c, v in zip(COUNTS, counts, strict=True)]
    return out + [np.where(blank, 0.0, v) for v in shares]


def text_statistics(df: DataFrame, text: str, words: list[str], han: list[str]) -> DataFrame:
    """``df`` without ``text``, plus the statistics of ``text``; columns of ``df`` with a statistic's name are dropped.

    NULL, empty and blank texts get zeros (fields: one). Whole texts count, however long. One narrow pass in Arrow batches.
    """
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != text and c not in COUNTS and c not in SHARES]
    schema = StructType([*(df.schema[c] for c in keep), *(StructField(c, IntegerType()) for c in COUNTS), *(StructField(c, DoubleType()) for c in SHARES)])
    both = frozenset(words), frozenset(han)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(b.column(len(keep))), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < b.num_rows:
                end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_CHARS, "right")))
                part = b.slice(at, end - at)
                made = describe(part.column(len(keep)), *both)
                cols = [pa.array(v, pa.int32() if k < len(COUNTS) else pa.float64(), safe=False) for k, v in enumerate(made)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *cols], names=[*keep, *COUNTS, *SHARES])
                at = end

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def published() -> dict[str, Column]:
    """Published rules for web text, with their own thresholds: what a text must not be."""
    c = F.col
    # Fixed values. Rae et al. 2021 (arXiv 2112.11446), table A1: words, their mean length, hashes and ellipses a word,
    # bulleted lines, lines ending in an ellipsis, words with a letter, at least two stop words.
    gopher = {
        "gopher_words": (c("n_words") < 50) | (c("n_words") > 100_000),
        "gopher_word_length": (c("mean_word_length") < 3) | (c("mean_word_length") > 10),
        "gopher_symbols": c("hash_ellipsis_ratio") > 0.1,
        "gopher_bullets": c("bullet_line_share") > 0.9,
        "gopher_ellipses": c("ellipsis_line_share") > 0.3,
        "gopher_alphabetic": c("alphabetic_share") < 0.8,
        "gopher_stop_words": c("distinct_common") + F.least(c("han_common"), F.lit(2)) < 2,
    }
    # Fixed values. Penedo et al. 2024 (arXiv 2406.17557), section 3.6: lines ending in punctuation, lines under 30 characters.
    return gopher | {"fineweb_punctuation": c("ended_line_share") <= 0.12, "fineweb_short_lines": c("brief_line_share") >= 0.67}


def rules() -> list[tuple[str, dict[str, Column]]]:
    """The fixed thresholds that decide: (kind, reason -> condition on the statistics), the first kind that holds wins.

    Published rules decide by their own thresholds where they hold for texts of any length, those on letters and short
    lines only for scripts with spaces and texts of some length. The rest use the same statistics with thresholds of our
    own: by theirs the published rules refuse every short message, and call many lists and tables prose.
    """
    known = published()
    c = F.col
    spaced = c("han_share") < 0.1
    regular = (
        ((c("pipe_regular") >= 0.6) | (c("tab_regular") >= 0.6) | ((c("semi_regular") >= 0.6) & (c("semi_fields") >= 3)) | ((c("comma_regular") >= 0.6) & (c("comma_fields") >= 3)))
        & (c("n_lines") >= 3)
        & (c("ended_line_share") < 0.3)
    )
    entries = (c("inline_bullets") >= 3) | (c("separators") >= 4)
    decide = {
        "junk": {
            "markup": c("tag_share") >= 0.3,
            "broken_encoding": (c("mojibake_share") >= 0.06) | (c("replacement_share") >= 0.1),
            "unbroken_tokens": (c("mean_token") >= 20) & (c("han_share") < 0.2) & ~regular,
            "symbols": (c("symbol_share") >= 0.25) & ~regular & (c("letter_share") < 0.6) & (c("separators") * 8 < c("n_tokens_ws")),
            "few_letters": (c("letter_share") < 0.6) & (c("n_lines") < 4) & ~entries & spaced,
            "few_common_words": ~regular & spaced & ~entries & (((c("n_words") >= 14) & (c("common_share") < 0.15)) | ((c("n_words") >= 6) & (c("common_share") < 0.1))) & ((c("n_lines") <= 2) | (c("mean_line_words") >= 9)),
            "no_common_words": ~regular & spaced & ~entries & (c("n_words") >= 5) & (c("common_words") == 0) & (c("n_lines") <= 2),
            "repeated_words": (c("n_words") >= 6) & (c("distinct_word_share") < 0.2) & (c("n_lines") <= 2) & ~entries & (c("distinct_common") <= 2) & spaced,
        },
        "table": {
            "regular_fields": regular,
            "aligned_columns": (c("gapped_line_share") >= 0.6) & (c("n_lines") >= 4) & (c("ended_line_share") < 0.5) & ((c("common_share") < 0.25) | (c("distinct_common") < 0.4 * c("n_lines"))),
            "figures": (c("letter_share") < 0.72) & (c("n_lines") >= 4) & spaced,
        },
        "list": {
            "bulleted_lines": (c("bullet_line_share") >= 0.65) & (c("mean_line_words") < 16) & (c("n_lines") >= 3),
            "short_lines": (c("n_lines") >= 5) & (c("mean_line_words") < 7.4) & (c("short_line_share") >= 0.8) & spaced & ((c("distinct_common") < 0.8 * c("n_lines")) | (c("mean_line_words") < 4)),
            "inline_entries": ((c("separators") >= 4) & (c("n_tokens_ws") < 9 * c("separators"))) | ((c("inline_bullets") >= 5) & (c("n_tokens_ws") < 10 * c("inline_bullets"))),
        },
    }
    long_enough = spaced & (c("n_tokens_ws") >= 20)
    return [
        *decide.items(),
        ("list", {"gopher_bullets": known["gopher_bullets"], "fineweb_short_lines": known["fineweb_short_lines"] & spaced & (c("n_lines") >= 3)}),
        ("junk", {**{k: known[k] for k in ("gopher_word_length", "gopher_symbols", "gopher_ellipses")}, "gopher_alphabetic": known["gopher_alphabetic"] & long_enough}),
    ]


def judge(stats: DataFrame) -> DataFrame:
    """``stats`` plus kind (prose, list, table, junk, blank), reasons, the rules that tell it from prose, and
    published_failures, the published rules it breaks.

    NULL, empty and blank texts are blank, with no reasons. Columns of these names are replaced.
    """
    some = F.col("n_solid") > 0
    table = rules()
    reasons = F.array_compact(F.array(*[F.when(some & cond, F.lit(f"{kind}:{why}")) for kind, own in table for why, cond in own.items()]))
    kind = F.when(~some, "blank")
    for k, own in table:
        kind = kind.when(reduce(or_, own.values()), k)
    broken = F.array_compact(F.array(*[F.when(some & cond, F.lit(name)) for name, cond in published().items()]))
    return stats.withColumns({"reasons": reasons, "published_failures": broken, "kind": kind.otherwise("prose")})
