"""Weighted combinatorial matrices: vocabularies, exact quotas, seeded decks, keyed draws.

Order where chance is wanted comes from md5 of the seed and the key, so any engine can replay it."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.store import written

AXES = "axis string, axis_pos int, pos int, value string, weight double"


def parse_axes(text: str, reserved: Sequence[str] = ()) -> list[tuple]:
    """Rows of AXES from `{name}` headers and indented values, `weight :: value` or plain; `#` lines are comments.

    Weights of an axis are all or none; they sum to 1, and without any are even."""
    axes: dict[str, list[tuple[str, float | None]]] = {}
    now = None
    for number, line in enumerate(text.splitlines(), 1):
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        head = re.fullmatch(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", bare)
        if head and not line[:1].isspace():
            now = head.group(1)
            if now in axes or now in reserved:
                raise ValueError(f"line {number}: {now} is taken")
            axes[now] = []
        elif now is None:
            raise ValueError(f"line {number}: a value before any header")
        else:
            weight, mark, value = bare.partition("::")
            axes[now].append((value.strip(), float(weight)) if mark else (bare, None))
    rows = []
    for a, (name, values) in enumerate(axes.items()):
        given = [w for _, w in values if w is not None]
        if given and (len(given) != len(values) or abs(sum(given) - 1) > 1e-6):
            raise ValueError(f"{name}: weights must be on all values and sum to 1")
        rows += [(name, a, i, v, w if w is not None else 1 / len(values)) for i, (v, w) in enumerate(values)]
    return rows


def axes(spark: SparkSession, text: str, reserved: Sequence[str] = ()) -> DataFrame:
    return spark.createDataFrame(parse_axes(text, reserved), AXES)


def quotas(vocabulary: DataFrame, n: int, tie: Column | None = None) -> DataFrame:
    """Each value's exact share of n by largest remainders; ties to the first value, or by `tie`."""
    w = Window.partitionBy("axis")
    exact = F.round(F.col("weight") * n, 9)
    floor = F.floor(exact)
    rest = F.lit(n) - F.sum("floor").over(w)
    place = F.row_number().over(w.orderBy(F.desc("remainder"), tie if tie is not None else F.col("pos")))
    q = vocabulary.withColumns({"floor": floor, "remainder": exact - floor}).withColumns({"rest": rest, "place": place})
    return q.withColumn("quota", (F.col("floor") + (F.col("place") <= F.col("rest")).cast("int")).cast("long")).drop("floor", "remainder", "rest", "place")


def order_key(seed, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def decks(vocabulary: DataFrame, n: int, seed: int) -> DataFrame:
    """slot, axis, value: every axis is a shuffled deck with exact quotas; decks are zipped by slot."""
    cards = quotas(vocabulary, n).where("quota > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))))
    slot = F.row_number().over(Window.partitionBy("axis").orderBy(order_key(seed, F.col("axis"), F.col("pos"), F.col("k")))) - 1
    return cards.select(slot.cast("long").alias("slot"), "axis", "axis_pos", "value")


def deal(vocabulary: DataFrame, n: int, seed: int) -> DataFrame:
    """slot, variables: a map of axis to value for each of n deals."""
    pairs = F.array_sort(F.collect_list(F.struct("axis_pos", "axis", "value")))
    entry = F.transform(pairs, lambda x: F.struct(x["axis"], x["value"]))
    return decks(vocabulary, n, seed).groupBy("slot").agg(F.map_from_entries(entry).alias("variables"))


def product(vocabulary: DataFrame, names: Sequence[str]) -> DataFrame:
    """All combinations in order, ids matrix_000000 on. The result is that product: vocabularies are short lists."""
    out = None
    for a in names:
        part = vocabulary.where(F.col("axis") == a).select(F.col("pos").alias(f"__{a}"), F.col("value").alias(a))
        out = part if out is None else out.crossJoin(part)
    sizes = {r["axis"]: r["c"] for r in vocabulary.groupBy("axis").agg(F.count(F.lit(1)).alias("c")).collect()}
    number = F.lit(0)
    for a in names:
        number = number * sizes[a] + F.col(f"__{a}")
    return out.select(F.format_string("matrix_%06d", number.cast("long")).alias("prompt_id"), *names)


def people(given: DataFrame, family: DataFrame, n: int, seed: int, locales: Sequence[str], family_first: Mapping[str, str] | None = None, banned: Sequence[str] = (), most: int = 40, fallback: Sequence[str] = ()) -> DataFrame:
    """locale, place, name, is_fallback: n names at most for each locale, composed of given(locale, name) and family(locale, name).

    Twice as many are drawn by hashes of the seed, so they are the same whenever asked. A locale of family_first puts the family's
    name first, with its own joiner. Names of `most` characters or more and names with a banned word go. A locale without
    any gets the fallback's names, with a warning, lest a few names stand for all unseen."""
    spark = given.sparkSession
    first = F.create_map(*[F.lit(x) for kv in (family_first or {"": ""}).items() for x in kv])
    wanted = spark.createDataFrame([(x,) for x in dict.fromkeys(locales)], "locale string")

    def drawn(names: DataFrame, kind: str) -> DataFrame:
        known = names.select("locale", "name").where("locale is not null and name <> ''").distinct().join(wanted, "locale", "left_semi")
        numbered = known.withColumns({"at": F.row_number().over(Window.partitionBy("locale").orderBy("name")) - 1, "of": F.count(F.lit(1)).over(Window.partitionBy("locale"))})
        draws = numbered.groupBy("locale").agg(F.max("of").alias("of")).select("locale", "of", F.explode(F.sequence(F.lit(1), F.lit(2 * n))).alias("k"))
        at = F.conv(F.substring(order_key(seed, F.col("locale"), F.lit(kind), F.col("k")), 1, 8), 16, 10).cast("long") % F.col("of")
        return draws.select("locale", "k", at.cast("int").alias("at")).join(numbered.drop("of"), ["locale", "at"]).select("locale", "k", F.col("name").alias(kind))

    both = drawn(given, "given").join(drawn(family, "family"), ["locale", "k"])
    name = F.when(first[F.col("locale")].isNotNull(), F.concat("family", first[F.col("locale")], "given")).otherwise(F.concat_ws(" ", "given", "family"))
    words = F.transform(F.split(name, " "), lambda w: F.lower(F.btrim(w, F.lit(".,"))))
    clean = both.where((F.length(name) < most) & ~F.arrays_overlap(words, F.array(*map(F.lit, banned)).cast("array<string>"))).select("locale", name.alias("name")).distinct()
    place = F.row_number().over(Window.partitionBy("locale").orderBy(order_key(seed, F.col("locale"), F.col("name")), "name"))
    found = written(clean.withColumn("place", place).where(F.col("place") <= n).select("locale", "place", "name", F.lit(False).alias("is_fallback")), "people")
    bare = sorted(r.locale for r in wanted.join(found, "locale", "left_anti").collect())  # a short list of locales
    if bare:
        warnings.warn(f"no names for {', '.join(bare)}: built-in ones stand in", stacklevel=2)
    rest = spark.createDataFrame([(x, i, f, True) for x in bare for i, f in enumerate(fallback, 1) if i <= n], found.schema)
    return found.unionByName(rest)


def blended(pool: DataFrame, n: int, seed: int) -> DataFrame:
    """place, name: n names of all locales together, each once."""
    once = pool.groupBy("name").agg(F.min("locale").alias("locale")).withColumn("h", order_key(seed, F.lit("blend"), F.col("name")))
    top = once.orderBy("h", "name").limit(n)
    return top.select(F.row_number().over(Window.orderBy("h", "name")).alias("place"), "name")  # n rows


def keyed_sample(keys: DataFrame, key: str, pool: DataFrame, item: str, k: int, seed: int, salt: str = "") -> DataFrame:
    """key, item, place: k items of the pool for each key, without repeats, the same whenever asked. Pools are short."""
    both = keys.select(key).distinct().crossJoin(F.broadcast(pool.select(item)))
    place = F.row_number().over(Window.partitionBy(key).orderBy(order_key(seed, F.concat(F.lit(salt), F.col(key).cast("string")), F.col(item)), item))
    return both.withColumn("place", place).where(F.col("place") <= k)


def weighted_choice(rows: DataFrame, key: str, vocabulary: DataFrame, seed: int, name: str) -> DataFrame:
    """rows with a value by weight, from a uniform number of the key's hash."""
    u = F.conv(F.substring(order_key(seed, F.col(key)), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    w = Window.orderBy("pos")
    ranges = vocabulary.withColumn("to", F.sum("weight").over(w)).withColumn("from", F.col("to") - F.col("weight")).select(F.col("value").alias(name), "from", "to")
    last = ranges.agg(F.max("to")).first()[0]
    return rows.withColumn("__u", F.least(u * last, F.lit(last * (1 - 1e-12)))).join(F.broadcast(ranges), (F.col("__u") >= F.col("from")) & (F.col("__u") < F.col("to"))).drop("__u", "from", "to")


def blinded_side(salt: str, pair: Column) -> Column:
    """a or b by the parity of the digest's last digit."""
    last = F.conv(F.right(F.md5(F.concat(F.lit(salt + ":"), pair.cast("string"))), F.lit(1)), 16, 10).cast("int")
    return F.when(last % 2 == 0, "a").otherwise("b")


def contains_map(rows: DataFrame, column: str, entries: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """rows with the value of the first entry whose key the column holds, whatever the case."""
    found = None
    for part, value in entries:
        hit = F.contains(F.lower(column), F.lit(part.lower()))
        found = F.when(hit, value) if found is None else found.when(hit, value)
    return rows.withColumn(name, found if found is not None else F.lit(None).cast("string"))


def problems(vocabulary: DataFrame, needed: Sequence[tuple[str, str]], shares: Sequence[tuple[str, float]] = (), most: float = 0.25) -> DataFrame:
    """All that is wrong with a vocabulary, a row each: values that rules need and that are absent, shares beyond the bound."""
    spark = vocabulary.sparkSession
    wanted = spark.createDataFrame(list(needed), "axis string, value string")
    absent = wanted.join(vocabulary, ["axis", "value"], "left_anti").select(F.concat_ws(": ", F.lit("missing"), "axis", "value").alias("problem"))
    total = sum(s for _, s in shares)
    over = spark.createDataFrame([(f"archetype shares sum to {total:.2f}",)] if total > most else [], "problem string")
    return absent.unionByName(over)


def deal_rules(deals: DataFrame) -> DataFrame:
    """Columns that follow from dealt ones: a trap is hidden, what is hidden goes unnoticed, an explicit but unaware card is
    neutral; a formal persona doesn't open casually; an explicit ask doesn't trail off; "none" is null."""
    v = lambda a: F.col("variables")[a]
    hidden = F.when(v("conflict") == "trap", "hidden").otherwise(v("visibility"))
    attitude = F.when(hidden == "hidden", "unaware").when((v("visibility") == "explicit") & (v("attitude") == "unaware"), "neutral").otherwise(v("attitude"))
    opening = F.when((v("persona") == "formal") & (v("opening") == "casual"), "plain").otherwise(v("opening"))
    closing = F.when((v("visibility") == "explicit") & (v("closing") == "trailing"), "question").otherwise(v("closing"))
    none = lambda c: F.nullif(c, F.lit("none"))
    return deals.select("slot", hidden.alias("visibility"), attitude.alias("attitude"), opening.alias("opening"), closing.alias("closing"), none(v("frame")).alias("frame"), F.concat_ws(" x ", v("severity"), v("scope")).alias("magnitude"))


def reserve(deals: DataFrame, specs: Sequence[tuple[str, float, dict[str, str]]], seed: int) -> DataFrame:
    """slot, variables, archetype, overwritten: round(share * n) deals meet each archetype's cards.

    Cards are swapped with unreserved deals, so every axis keeps its marginals; a card that no deal can give is written
    over and recorded. It is sequential by nature: the deals of one run, a few thousand, are one group."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", ignore_index=True)
        cards = [dict(v) for v in pdf.variables]
        names: list = [None] * len(cards)
        over: list = [[] for _ in cards]
        for name, share, wanted in specs:
            free = [i for i in range(len(cards)) if names[i] is None]
            free.sort(key=lambda i: (-sum(cards[i].get(a) == x for a, x in wanted.items()), i))
            for i in free[: round(share * len(cards))]:
                names[i] = name
                for axis, value in wanted.items():
                    if cards[i].get(axis) != value:
                        partner = next((j for j in range(len(cards)) if names[j] is None and cards[j].get(axis) == value), None)
                        if partner is None:
                            over[i].append(axis)
                            cards[i][axis] = value
                        else:
                            cards[i][axis], cards[partner][axis] = value, cards[i][axis]
        return pd.DataFrame({"slot": pdf.slot, "variables": cards, "archetype": names, "overwritten": over})

    return deals.withColumn("__g", F.lit(0)).groupBy("__g").applyInPandas(lambda pdf: work(pdf), "slot long, variables map<string,string>, archetype string, overwritten array<string>")


def capped_second(deals: DataFrame, axis: str, seed: int, p: float = 0.30, cap: float = 0.12) -> DataFrame:
    """slot, first, second: in order of the slots a coin gives a second, different value that still is below its cap of
    max(1, int(cap * n)) uses; counts grow as rows are visited. One run's deals, as reserve()."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        pdf = pdf.sort_values("slot", ignore_index=True)
        n, firsts = len(pdf), [v.get(axis) if isinstance(v, dict) else dict(v).get(axis) for v in pdf.variables]
        most, used = max(1, int(cap * n)), {}
        for x in firsts:
            used[x] = used.get(x, 0) + 1
        out = []
        for slot, x in zip(pdf.slot, firsts):
            h = hashlib.md5(f"{seed}:{slot}".encode()).hexdigest()
            able = sorted(y for y in used if y != x and used[y] < most)
            pick = able[int(h[8:16], 16) % len(able)] if able and int(h[:8], 16) / 2**32 < p else None
            if pick:
                used[pick] += 1
            out.append(pick)
        return pd.DataFrame({"slot": pdf.slot, "first": firsts, "second": out})

    return deals.withColumn("__g", F.lit(0)).groupBy("__g").applyInPandas(lambda pdf: work(pdf), "slot long, first string, second string")


def render(deals: DataFrame, template: str, vocabulary: Sequence[str]) -> DataFrame:
    """slot, prompt: the template's {slots} from each deal; an error lists all slots that no axis fills."""
    slots = list(dict.fromkeys(re.findall(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", template)))
    if re.search(r"\{[A-Za-z_][A-Za-z0-9_]*[:!][^}]*\}", template):
        raise ValueError("slots take no conversion or format")
    if missing := [s for s in slots if s not in vocabulary]:
        raise KeyError(f"no axis fills {', '.join(missing)}")
    out = F.lit(template)
    for s in slots:
        out = F.replace(out, F.lit("{" + s + "}"), F.col("variables")[s])
    return deals.select("slot", out.alias("prompt"))
