"""Reading postal addresses as people write them: house number, street and the parts of a street's name."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.session import ship

# Words of street names and the ways they are shortened.
SUFFIXES = {
    "STREET": "ST STR STRT",
    "AVENUE": "AV AVE AVEN AVN",
    "ROAD": "RD",
    "PLACE": "PL PLC",
    "BOULEVARD": "BL BLVD BOUL BLV",
    "LANE": "LA LN",
    "DRIVE": "DR DRV",
    "COURT": "CT CRT",
    "TERRACE": "TER TERR TE",
    "CRESCENT": "CRES CRS CRESC",
    "SQUARE": "SQ SQR",
    "PARKWAY": "PKWY PKY PWY",
    "HIGHWAY": "HWY",
    "EXPRESSWAY": "EXPY",
    "ALLEY": "ALY",
    "CIRCLE": "CIR",
    "PLAZA": "PLZ",
    "TURNPIKE": "TPKE",
}
PREFIXES = {
    "NORTH": "N NO NTH",
    "SOUTH": "S SO STH",
    "EAST": "E EST",
    "WEST": "W WST",
    "OLD": "OL",
    "NEW": "NW",
    "GREAT": "GT GRT GR",
    "LITTLE": "LTL",
    "UPPER": "UP UPR UPP",
    "LOWER": "LWR LOW LR",
    "MOUNT": "MT MNT",
    "SAINT": "ST STE SNT",
    "FORT": "FT",
    "FIRST": "1ST",
    "SECOND": "2ND",
    "THIRD": "3RD",
    "FOURTH": "4TH",
    "FIFTH": "5TH",
    "SIXTH": "6TH",
    "SEVENTH": "7TH",
    "EIGHTH": "8TH",
    "NINTH": "9TH",
    "TENTH": "10TH",
}
BOROUGHS = {"1": "MANHATTAN MN NEW YORK", "2": "BRONX BX", "3": "BROOKLYN BK", "4": "QUEENS QN", "5": "STATEN ISLAND SI"}
#: Shortened words that are also the ends of names (-minster, -haven), where these were written apart.
NAME_ENDS = ("TER", "AVEN")
#: Digits typed for letters.
LOOKS_LIKE = str.maketrans("013458", "OIEASB")

_WORD: dict[str, tuple[str, str]] = {}
for _kind, _table in (("suf", SUFFIXES), ("pre", PREFIXES)):
    for _full, _short in _table.items():
        for _w in (_full, *_short.split()):
            if _w not in ("ST", "STE"):
                _WORD.setdefault(_w, (_kind, _full))
_ORDINAL_END = {1: "ST", 2: "ND", 3: "RD"}

_CITY = r"NEW YORK|BROOKLYN|BRONX|QUEENS|MANHATTAN|STATEN ISLAND"
_TAILS = [
    re.compile(p)
    for p in (
        r"[ ,.]+(?:NY|N\.Y\.?)?[ ,]*1[0-9]{4}(?:-[0-9]{4})?$",
        r"[ ,.]+(?:NY|N\.Y\.?)$",
        rf"[ ,.]+(?:{_CITY})$",
        r"[ ,.]+[0-9]{1,2} ?(?:ST|ND|RD|TH) (?:FL|FLR|FLOOR)$",
        r"[ ,.]+(?:APT|APARTMENT|UNIT|SUITE|RM|ROOM|FLOOR|FL)\b\.?[ #]*[0-9]{0,3}[ -]?[A-Z]?$",
        r"[ ,.]+# ?[0-9]{1,3}[ -]?[A-Z]?$",
        r"[ ,.]+(?:REAR|FRNT|FRONT|BSMT|BASEMENT|LOBBY|PH|REAR BLDG|FRONT BLDG)$",
    )
]
_NUM = r"(?:NO\b|NUMBER\b|#)?[ .]*0*([0-9]+)(?: ?[-/] ?([0-9]+))?(?:(?: ?- ?|)([A-Z])| ([A-DF-MO-RT-VX-Z]))?"
_FRONT = re.compile(rf"^{_NUM}(?=[ ,.]|$)[ ,.]*(.*)$")
_BACK = re.compile(rf"^(.*?[A-Z].*?)[ ,.]+{_NUM}[ .,]*$")
_SPLIT_ORDINAL = re.compile(r"^([0-9]{1,2}) (ST|ND|RD|TH)\b")


def _is_ordinal(number: str, end: str) -> bool:
    return _ORDINAL_END.get(int(number), "TH") == end


def _house(a: str, b: str | None, letter: str | None) -> str:
    # a hyphen, slash or nothing between the parts of a number makes no difference
    return f"{int(a)}{b or ''}{letter or ''}"


def read_line(text: str | None) -> tuple[str | None, str, str | None]:
    """(house number or None, street text, borough code named at the end or None) of one address line."""
    if not text:
        return None, "", None
    read = _read_line(text, _TAILS)
    if read[0] is None and "#" in text:  # the number sign may mark the house instead of a unit
        again = _read_line(text, [p for p in _TAILS if "#" not in p.pattern[:9]])
        return again if again[0] is not None else read
    return read


def _read_line(text: str, tails: list[re.Pattern]) -> tuple[str | None, str, str | None]:
    u = re.sub(r"[‐‑‒–—−]", "-", text.upper())
    u = re.sub(r"\([^()]*\)", " ", u)
    u = re.sub(r"\s+", " ", u).strip(" ,.;")
    borough, again = None, True
    while again:
        again = False
        for p in tails:
            m = p.search(u)
            if m and m.start() > 0:
                name = m.group().strip(" ,.")
                for code, names in BOROUGHS.items():
                    if name and names.startswith(name) or name == "NEW YORK" and code == "1":
                        borough = borough or code
                u = u[: m.start()].rstrip(" ,.;-")
                again = True
    house = None
    m = _SPLIT_ORDINAL.match(u)
    if not (m and _is_ordinal(m[1], m[2])):
        m = _FRONT.match(u)
        if m and re.search("[A-Z]{2}", m[5]):
            house, u = _house(m[1], m[2], m[3] or m[4]), m[5]
            m = _FRONT.match(u)  # the number may stand in both fields
            if m and _house(m[1], m[2], m[3] or m[4]) == house and re.search("[A-Z]{2}", m[5]):
                u = m[5]
    if house is None:
        m = _BACK.match(u)
        if m:
            house, u = _house(m[2], m[3], m[4] or m[5]), m[1]
    return house, " ".join(re.sub(r"['’`]", "", re.sub(r"([A-Z])-(?=[A-Z])", r"\1", u)).replace("-", " ").replace(".", " ").replace(",", " ").split()), borough


def _edits(word: str) -> set[str]:
    """Words one slip away: a letter lost, doubled or wrong, or two swapped."""
    abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1} | {a + c + b[1:] for a, b in cuts if b for c in abc} | {a + c + b for a, b in cuts for c in abc}


_SLIPS: dict[str, tuple[str, str]] = {}
for _kind, _table in (("suf", SUFFIXES), ("pre", PREFIXES)):
    for _full in _table:
        if len(_full) >= 4:
            for _e in sorted(_edits(_full)):
                if len(_e) >= 3 and _e not in _WORD:
                    _SLIPS.setdefault(_e, (_kind, _full))


@lru_cache(maxsize=200_000)
def street_forms(street: str) -> tuple[tuple[str, str, str], ...]:
    """The readings of a street text as (core, prefix, suffix), the likeliest first; missing parts are ''."""
    raw, words = street.split(), []
    i = 0
    while i < len(raw):
        w = raw[i]
        if w.isdigit() and i + 1 < len(raw) and raw[i + 1] in ("ST", "ND", "RD", "TH") and _is_ordinal(w, raw[i + 1]):
            words.append(w + raw[i + 1])
            i += 2
            continue
        if any(c.isdigit() for c in w) and sum(c.isalpha() for c in w) >= 2 and w not in _WORD:
            w = w.translate(LOOKS_LIKE)
        words.append(w)
        i += 1
    kinds: list[tuple[str, str] | None] = []
    for w in words:
        kinds.append(("st", "ST") if w in ("ST", "STE") else _WORD.get(w))
    slips = [k is None and w in _SLIPS for w, k in zip(words, kinds, strict=True)]

    def read(use_slips: bool, saint: bool | None, joined: int = -1) -> tuple[str, str, str]:
        core, pre, suf, st = [], [], [], []
        for at, (w, k) in enumerate(zip(words, kinds, strict=True)):
            if use_slips and slips[at]:
                k = _SLIPS[w]
            if at == joined:
                k = None
            if k is None:
                core.append(w)
            elif k[0] == "st":
                st.append(at)
            else:
                (pre if k[0] == "pre" else suf).append(k[1])
        if len(st) > 1:
            pre, suf = [*pre, "SAINT"], suf or ["STREET"]
        elif st:
            alone = not suf and (st[0] == len(words) - 1 if saint is None else not saint)
            if alone and words[st[0]] == "ST":
                suf = ["STREET"]
            else:
                pre = [*pre, "SAINT"]
        return "".join(core), " ".join(sorted(set(pre))), suf[-1] if suf else ""

    out = [read(True, None)]
    if any(k == ("st", "ST") for k in kinds):
        out += [read(True, True), read(True, False)]
    if any(slips):
        out.append(read(False, None))
    for at in range(1, len(words)):  # the end of a name may stand apart and look like a word of its own
        k = kinds[at]
        more = words[at] in NAME_ENDS or any(o is not None and o[0] in ("suf", "st") and i != at for i, o in enumerate(kinds))
        if kinds[at - 1] is None and not slips[at - 1] and k is not None and len(words[at]) <= 4 and (k[0] == "pre" or k[0] == "suf" and more):
            out.append(read(True, None, at))
    return tuple(dict.fromkeys(f for f in out if len(f[0]) >= 2))


_CLASS = {c: str(n) for n, group in enumerate(("BFPV", "CGJKQSXZ", "DT", "L", "MN", "R"), 1) for c in group}


def sound(part: str) -> str:
    """The classes of a word's consonants, runs once; a word of vowels gives '0'."""
    out = ""
    for c in part:
        k = _CLASS.get(c, "")
        if k and k != out[-1:]:
            out += k
    return out or "0"


def block_keys(core: str) -> list[str]:
    """Sound of the beginning and of the end, short enough that one slip leaves one of them whole.

    Names of nearly the length where the parts get longer have the keys of both lengths, since a slip may change it.
    """
    n = len(core)
    sizes = (4,) if n >= 10 else (3, 4) if n >= 7 else (2, 3)
    return sorted({f"{side}{k}{sound(part)}" for k in sizes for side, part in (("<", core[:k]), (">", core[-k:]))})


def borough_code(*names: Column) -> Column:
    """1 to 5 from names, codes or two-letter forms, the first that is known; else NULL."""
    found = []
    for c in names:
        u = F.upper(F.btrim(c, F.lit(" \t\n\r")))
        found.append(F.when(u.isin("1", "MANHATTAN", "MN", "NEW YORK"), "1").when(u.isin("2", "BRONX", "BX"), "2").when(u.isin("3", "BROOKLYN", "BK"), "3").when(u.isin("4", "QUEENS", "QN"), "4").when(u.isin("5", "STATEN ISLAND", "SI"), "5"))
    return F.coalesce(*found)


def read_addresses(df: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """``keep`` (string columns) plus house, street, named (borough code named in the line or NULL) from the text ``line``.

    NULL and empty lines have no house and an empty street. One narrow pass, no shuffle.
    """

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(maxsize=100_000)(read_line)
        for b in batches:
            rows = [read(t) for t in b.column(len(keep)).to_pylist()]
            cols = [pa.array([r[k] for r in rows], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], names=[*keep, "house", "street", "named"])

    return df.select(*keep, line).mapInArrow(run, ", ".join(f"`{k}` string" for k in keep) + ", house string, street string, named string")


def forms_of(streets: DataFrame) -> DataFrame:
    """(borough, street, ..., rank, core, pre, suf, blocks) for each reading of each row of (borough, street, ...)."""
    names = streets.columns
    at = names.index("street")
    ship(streets.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in streets.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, rank, parts = [], [], []
            for i, s in enumerate(b.column(at).to_pylist()):
                for k, f in enumerate(street_forms(s or "")):
                    row.append(i)
                    rank.append(k)
                    parts.append(f)
            cols = [pa.array([p[k] for p in parts], pa.string()) for k in range(3)]
            blocks = pa.array([block_keys(p[0]) for p in parts], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(row, pa.int64())).columns, pa.array(rank, pa.int32()), *cols, blocks], names=[*names, "rank", "core", "pre", "suf", "blocks"])

    return streets.mapInArrow(run, schema + ", rank int, core string, pre string, suf string, blocks array<string>")
