"""The same postal address written differently: streets linked by blocked comparison and EM weights, then addresses joined.

Records are many and streets are few, so comparison runs over distinct street texts: each is read into parts, blocked on
the sound of its name's beginning and end within a borough, compared part by part (name, prefix, suffix; each of the
latter with a level for a missing value) with the streets the lots form, and the pattern's weight from
expectation-maximisation picks the street. Addresses are then one join on street and house number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.llm.address import forms_of
from lotline.session import cut

#: Levels of agreement: name 3 equal, 2 one slip, 1 two slips; parts 2 equal, 1 missing on one side, 0 different.
LEVELS = {"name": 4, "pre": 3, "suf": 3}
MIN_PROBABILITY = 0.5
#: So many house numbers, or this share of the other street's bearers, may have a street's name with the same part missing or the same slip.
MISSING, SLIPS, ACCIDENT_SHARE = 3, 5, 0.01


def estimate_weights(patterns: dict[tuple[int, int, int], float], rounds: int = 60, prior: float = 1.0) -> tuple[dict[tuple[int, int, int], float], dict[tuple[int, int, int], float]]:
    """(weight, probability of a match) of each pattern of levels, by expectation-maximisation over pattern counts.

    Two classes with independent levels; Dirichlet priors keep rare levels finite, and a higher level of agreement never
    weighs less than a lower one. Unlabelled; no counts give no weights.
    """
    sizes = list(LEVELS.values())
    m = [[(k + 0.2) ** 2 for k in range(n)] for n in sizes]
    u = [[float(n - k) for k in range(n)] for n in sizes]
    norm = lambda row: [x / sum(row) for x in row]
    m, u, p = [norm(r) for r in m], [norm(r) for r in u], 0.7
    total = sum(patterns.values())
    score = lambda t, pat: math.prod(t[f][lv] for f, lv in enumerate(pat))
    for _ in range(rounds if total else 0):
        post = {}
        for pat in patterns:
            a, b = p * score(m, pat), (1 - p) * score(u, pat)
            post[pat] = a / (a + b)
        p = (sum(n * post[k] for k, n in patterns.items()) + 1) / (total + 2)
        m = [norm([prior + sum(n * post[k] for k, n in patterns.items() if k[f] == lv) for lv in range(size)]) for f, size in enumerate(sizes)]
        u = [norm([prior + sum(n * (1 - post[k]) for k, n in patterns.items() if k[f] == lv) for lv in range(size)]) for f, size in enumerate(sizes)]
    per = []
    for f, size in enumerate(sizes):
        w = [math.log2(m[f][lv] / u[f][lv]) for lv in range(size)]
        for lv in range(1, size):  # agreement is monotone
            w[lv] = max(w[lv], w[lv - 1] + 0.05)
        per.append(w)
    weight = {k: sum(per[f][lv] for f, lv in enumerate(k)) for k in patterns}
    odds = math.log2(p / (1 - p))
    return weight, {k: 1 / (1 + 2 ** -max(-500.0, min(500.0, w + odds))) for k, w in weight.items()}


def _name_level(a: Column, b: Column) -> Column:
    d = F.levenshtein(a, b, 2)
    swapped = (d == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    long = F.least(F.length(a), F.length(b))
    return F.when(d == 0, 3).when(((d == 1) & (long >= 4)) | (swapped & (long >= 5)), 2).when((d == 2) & (long >= 7), 1).otherwise(0)


def _part_level(a: Column, b: Column) -> Column:
    return F.when(a == b, 2).when((a == "") | (b == ""), 1).otherwise(0)


def near_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """(borough, core, name, level) for cores (borough, core, blocks) and known names (borough, core, blocks) within two slips.

    A core that is a known name goes to it alone; only the others are compared, within their sound blocks.
    """
    same = names.join(known.select("borough", "core"), ["borough", "core"], "left_semi").select("borough", "core", F.col("core").alias("name"), F.lit(3).alias("level"))
    other = names.join(known.select("borough", "core"), ["borough", "core"], "left_anti").select("borough", "core", F.explode("blocks").alias("block"))
    have = known.select("borough", F.col("core").alias("name"), F.explode("blocks").alias("block"))
    near = other.join(have, ["borough", "block"]).select("borough", "core", "name", _name_level(F.col("core"), F.col("name")).alias("level")).where("level > 0").distinct()
    return same.unionByName(near)


def known_streets(lots: DataFrame) -> DataFrame:
    """(borough, core, pre, suf, support): the readings of lot streets (borough, street, n, houses) that stand for a street.

    A reading gives way to one that has the suffix it lacks, or, if no more bear it than the same accident may befall, to
    one that many more bear and that differs by slips or a missing part only. Different prefixes or suffixes make
    different streets however few bear them. House numbers are counted for that, each once: one slip may befall all
    things at a number, and stand before more than one way of writing the suffix.
    """
    parts = ["borough", "core", "pre", "suf"]
    read = cut(forms_of(lots))
    first = read.where("rank = 0").groupBy(*parts).agg(F.sum("n").alias("bearers"))
    # of several readings of a text the one that most lots bear counts
    picked = read.join(first, parts, "left").groupBy("borough", "street", "n").agg(F.max_by(F.struct("core", "pre", "suf", "blocks", "houses"), F.struct(F.coalesce("bearers", F.lit(0)), -F.col("rank"))).alias("f")).select("borough", "n", "f.*")
    forms = cut(picked.groupBy(*parts).agg(F.sum("n").alias("support"), F.first("blocks").alias("blocks"), F.size(F.array_distinct(F.flatten(F.collect_list("houses")))).alias("numbers")))
    a = forms.select("borough", F.col("core").alias("c1"), F.col("pre").alias("p1"), F.col("suf").alias("s1"), F.col("support").alias("n1"), F.explode("blocks").alias("block"))
    b = forms.select("borough", "core", "pre", "suf", "support", "numbers", F.explode("blocks").alias("block"))
    level = _name_level(F.col("core"), F.col("c1"))
    compatible = (_part_level(F.col("pre"), F.col("p1")) > 0) & (_part_level(F.col("suf"), F.col("s1")) > 0)
    few = lambda most: F.col("numbers") <= F.greatest(F.lit(most), F.col("n1") * ACCIDENT_SHARE)
    gives_way = (
        ((level == 3) & (F.col("pre") == F.col("p1")) & (F.col("suf") == "") & (F.col("s1") != ""))
        | ((level == 3) & compatible & few(MISSING) & (F.col("n1") >= 10 * F.col("support")))
        | (level.isin(1, 2) & compatible & few(SLIPS) & (F.col("n1") > F.col("support")) & (F.col("n1") >= 8 * F.col("support")))
    )
    beaten = b.join(a, ["borough", "block"]).where(~((F.col("core") == F.col("c1")) & (F.col("pre") == F.col("p1")) & (F.col("suf") == F.col("s1")))).where(gives_way).select("borough", "core", "pre", "suf").distinct()
    return forms.drop("numbers").join(beaten, ["borough", "core", "pre", "suf"], "left_anti")


def link_streets(texts: DataFrame, lots: DataFrame) -> DataFrame:
    """(borough, street, street_id, weight, probability, ties) for street texts (borough, street, n).

    ``lots`` has the texts of lots, n being lots, and their distinct house numbers (array houses). The probability decides:
    a text without a likely street doesn't come out, however its name reads; one with several
    equally good streets comes out once for each, with ties > 1. NULL boroughs or streets and streets without a name
    have no street. Repeated rows must be counted in n beforehand.
    """
    known = cut(known_streets(lots))
    forms = cut(forms_of(texts.select("borough", "street", "n")))
    names = forms.select("borough", "core", "blocks").dropDuplicates(["borough", "core"])
    have = known.select("borough", "core", "blocks").dropDuplicates(["borough", "core"])
    near = near_names(names, have)
    streets = known.select("borough", F.col("core").alias("name"), F.col("pre").alias("p1"), F.col("suf").alias("s1"), F.concat_ws("|", "borough", "pre", "core", "suf").alias("street_id"))
    level = F.struct("name_level", "pre_level", "suf_level")
    total = F.col("name_level") + F.col("pre_level") + F.col("suf_level")
    pairs = cut(  # of a text's readings the best counts for each street
        forms.select("borough", "street", "n", "core", "pre", "suf")
        .join(near, ["borough", "core"])
        .join(streets, ["borough", "name"])
        .select("borough", "street", "n", "street_id", F.col("level").alias("name_level"), _part_level(F.col("pre"), F.col("p1")).alias("pre_level"), _part_level(F.col("suf"), F.col("s1")).alias("suf_level"))
        .groupBy("borough", "street", "n", "street_id")
        .agg(F.max_by(level, F.struct(total, level)).alias("l"))
        .select("borough", "street", "n", "street_id", "l.*")
    )
    counts = pairs.groupBy("name_level", "pre_level", "suf_level").agg(F.sum("n").alias("n")).collect()  # at most 27 patterns
    weight, prob = estimate_weights({(r[0], r[1], r[2]): float(r.n) for r in counts})
    if not weight:
        return pairs.select("borough", "street", "street_id", F.lit(0.0).alias("weight"), F.lit(0.0).alias("probability"), F.lit(0).alias("ties"))
    table = pairs.sparkSession.createDataFrame([(*k, w, prob[k]) for k, w in weight.items()], "name_level int, pre_level int, suf_level int, weight double, probability double")
    scored = pairs.join(F.broadcast(table), ["name_level", "pre_level", "suf_level"]).where(F.col("probability") >= MIN_PROBABILITY)  # at most 27 rows
    text = Window.partitionBy("borough", "street")
    best = scored.withColumn("top", F.max("weight").over(text)).where("weight >= top")
    return best.select("borough", "street", "street_id", "weight", "probability", F.count(F.lit(1)).over(text).cast("int").alias("ties"))


def link_addresses(lines: DataFrame) -> DataFrame:
    """(record_id, target_id, probability): records whose address is a target's.

    ``lines`` (side 'record', 'target' or 'street', id, borough, house, street) holds all sides, read by
    ``address.read_addresses``; rows of side 'street' only tell which streets exist. Rows without id, borough, house or street have no partner; repeated rows count once; an
    empty side gives an empty result. A record whose street text fits several streets equally is linked only if one of
    them has its house number.
    """
    ok = lines.where("id is not null and borough is not null and house is not null and street <> ''").select("side", "id", "borough", "house", "street")
    ok = cut(ok)  # repeated rows are counted together below, before they move
    targets = ok.where("side <> 'record'").groupBy("borough", "street").agg(F.count_distinct("id").alias("n"), F.collect_set("house").alias("houses"))
    texts = ok.groupBy("borough", "street").agg(F.count(F.lit(1)).alias("n"))  # weights of the estimation only
    links = cut(link_streets(texts, targets))
    placed = ok.join(links, ["borough", "street"])
    left = placed.where("side = 'record'").select(F.col("id").alias("record_id"), "street_id", "house", "probability", "ties")
    right = placed.where("side = 'target' and ties = 1").select(F.col("id").alias("target_id"), "street_id", "house").distinct()
    met = left.join(right, ["street_id", "house"])
    sure = met.where("ties = 1").select("record_id", "target_id", "probability")
    record = Window.partitionBy("record_id")
    torn = met.where("ties > 1").withColumns({"first": F.min("street_id").over(record), "last": F.max("street_id").over(record)}).where("first = last")
    return sure.unionByName(torn.select("record_id", "target_id", "probability")).groupBy("record_id", "target_id").agg(F.max("probability").alias("probability"))


def zip_boroughs(df: DataFrame, zipcode: Column, borough: Column) -> DataFrame:
    """(zip, borough): the borough most rows of a five-digit postcode name. At most 100,000 rows by construction."""
    z = F.regexp_extract(zipcode, "^\\s*([0-9]{5})", 1)
    n = df.select(z.alias("zip"), borough.alias("b")).where("zip <> '' and b is not null").groupBy("zip", "b").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("zip").agg(F.max_by("b", F.struct("n", "b")).alias("zip_borough"))
