"""Counts by keys, over many subgroup sets, with and without the cells nobody fell into."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.functions.columns import add_limbs, exact_addends, exact_limbs, exact_result, plain_sum
from rollwright.operators.filters import combination_mask
from rollwright.operators.numbering import rank_groups
from rollwright.session import materialise

_N = "__n"
_SET = "__set"


def group_count(df: DataFrame, keys: Sequence[str], id_column: str, name: str = "Counts") -> DataFrame:
    """Count the non-null IDs of each group."""
    return df.groupBy(*keys).agg(F.count(id_column).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def table_height(df: DataFrame, name: str = "height") -> DataFrame:
    """Row count as a one-row table, so it can go into an output without passing the driver."""
    return df.agg(F.count("*").alias(name))


def max_length(df: DataFrame, column: str, in_bytes: bool = False, name: str = "max_length") -> DataFrame:
    return df.agg(F.max((F.octet_length if in_bytes else F.length)(F.col(column))).alias(name))


def exact_sum(column: str, result: str = "double") -> Column:
    """Decimal-exact sum of integers, decimals or doubles, skipping null and NaN; 0 over nothing.

    Doubles count as the decimal text that Spark prints for them; ordinary numbers are summed as decimals, so that only
    the others, and the sums, are cut by their text. ``result`` is the type to return:
    ``double`` (rounded once, at the end), a decimal type, or ``string`` for every digit. A value with more than
    ``EXACT_DIGITS`` digits on a side of the point, and a sum that the result type cannot hold, are errors.
    """
    addends, by_text = exact_addends(column)
    sums, rest_limbs = [F.sum(a) for a in addends], [F.sum(limb) for limb in exact_limbs(column, by_text)]
    total = exact_result(add_limbs(sums, rest_limbs), result)
    if result == "double":
        fits, short = plain_sum(sums)
        total = F.when(rest_limbs[0].isNull() & fits, short.cast(result)).otherwise(total)
    return total.alias(f"exact_sum({column})")


def ordered_union(lists: Sequence[Sequence[str]]) -> list[str]:
    """All names of several lists, each once, in first-seen order."""
    return list(dict.fromkeys(name for names in lists for name in names))


def finest_counts(df: DataFrame, columns: Sequence[str], id_column: str) -> DataFrame:
    """Counts at the finest grain. Every subgroup set is a sum over these few rows, so the facts are
    read, and shrunk map-side, once and not once for each set."""
    return df.groupBy(*columns).agg(F.count(id_column).alias(_N))


def _set_ids(subgroup_sets: Sequence[Sequence[str]], subgroups: Sequence[str]) -> list[int]:
    """The bit mask ``grouping_id`` gives each set: first column highest, 1 = unused."""
    width = len(subgroups)
    return [sum(1 << (width - 1 - i) for i, c in enumerate(subgroups) if c not in s) for s in subgroup_sets]


def _roll(fine: DataFrame, basic: Sequence[str], subgroup_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Sum the finest counts over every set; unused subgroup columns hold ''.

    A null in a *used* key drops the row for that set only. ``grouping`` tells it from the null that
    stands for "not used".
    """
    subgroups = [c for c in ordered_union(subgroup_sets) if c not in basic]
    sets = [[*basic, *[c for c in s if c not in basic]] for s in subgroup_sets]
    keys = [*basic, *subgroups]
    unused = {c: f"__unused_{i}" for i, c in enumerate(subgroups)}
    rolled = fine.groupingSets(sets, *keys).agg(
        F.sum(_N).alias(_N), *[F.grouping(c).alias(u) for c, u in unused.items()]
    )
    rolled = rolled.na.drop(subset=list(basic)) if basic else rolled
    set_id = F.lit(0)
    shown = []
    for i, (c, u) in enumerate(unused.items()):
        rolled = rolled.where((F.col(u) == 1) | F.col(c).isNotNull())
        set_id = set_id + F.col(u).cast("int") * (1 << (len(subgroups) - 1 - i))
        shown.append(F.when(F.col(u) == 1, F.lit("")).otherwise(F.col(c).cast("string")).alias(c))
    return rolled.select(*basic, *shown, F.col(_N), set_id.alias(_SET))


def subgroup_rollup(
    df: DataFrame,
    basic: Sequence[str],
    subgroup_sets: Sequence[Sequence[str]],
    id_column: str,
    name: str = "Counts",
    total_flag: str | None = None,
) -> DataFrame:
    """Counts for each subgroup set, stacked. ``total_flag`` adds whether no subgroup is used."""
    wanted = ordered_union([basic, *subgroup_sets])
    rolled = _roll(finest_counts(df, wanted, id_column), basic, subgroup_sets)
    return _publish_rollup(rolled, basic, subgroup_sets, name, total_flag)


def _publish_rollup(
    rolled: DataFrame,
    basic: Sequence[str],
    subgroup_sets: Sequence[Sequence[str]],
    name: str,
    total_flag: str | None,
) -> DataFrame:
    subgroups = [c for c in ordered_union(subgroup_sets) if c not in basic]
    out = rolled.withColumnRenamed(_N, name)
    if total_flag:
        out = out.withColumn(total_flag, F.col(_SET) == (1 << len(subgroups)) - 1)
    return out.drop(_SET)


def _rule_key(allowed: Sequence[Mapping[str, Sequence[Any]]], rule: int, column: str) -> int:
    """Which dictionary of a column a rule draws on: its own where it names the column, else the whole one (-1)."""
    return rule if allowed and column in allowed[rule] else -1


def column_dictionaries(
    df: DataFrame,
    columns: Sequence[str],
    texts: Sequence[str] = (),
    domains: Mapping[str, Sequence[Any]] | None = None,
    allowed: Sequence[Mapping[str, Sequence[Any]]] = (),
) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Distinct non-null values of all columns as rows ``__c, __rule, __v0 .. __vn, __rank``, and how many each has.

    ``__c`` is the place of the column, whose value stands in ``__v<place>``; ranks count from 0 for every
    column, and for every rule of ``allowed`` that names it among the values that the rule lists. Values of
    ``texts`` are taken as text. ``domains`` gives the values of a column instead of the data. The sizes, a
    number for each column and rule, are the only thing that reaches the driver.
    """
    domains = domains or {}
    shown = {c: F.col(c).cast("string") if c in texts else F.col(c) for c in columns}
    types = dict(df.select(*[v.alias(c) for c, v in shown.items()]).dtypes)
    found = None
    for place, column in enumerate(columns):
        if column in domains:
            given = F.array(*[F.lit(v) for v in domains[column]]).cast(f"array<{types[column]}>")
            one = df.sparkSession.range(1).select(F.explode(given).alias("v"))
        else:
            one = df.select(shown[column].alias("v"))
        rules = [F.lit(-1)] + [
            F.when(F.col("v").isin(*rule[column]), F.lit(i)) for i, rule in enumerate(allowed) if column in rule
        ]
        empty = [F.lit(None).cast(types[c]).alias(f"__v{i}") for i, c in enumerate(columns)]
        empty[place] = F.col("v").alias(f"__v{place}")
        rows = one.where("v IS NOT NULL").distinct().select(
            F.lit(place).alias("__c"), F.explode(F.array_compact(F.array(*rules))).alias("__rule"), *empty
        )
        found = rows if found is None else found.unionByName(rows)
    ranked, heights = rank_groups(found, "__rank", ["__c", "__rule"])
    sizes = {(r["__c"], r["__rule"]): r["height"] for r in heights.collect()}
    return ranked, sizes


def cross_scaffold(
    df: DataFrame,
    basic: Sequence[str],
    subgroup_sets: Sequence[Sequence[str]] = ((),),
    domains: Mapping[str, Sequence[Any]] | None = None,
    allowed: Sequence[Mapping[str, Sequence[Any]]] | None = None,
) -> DataFrame:
    """Every combination of the values of the used columns, for each subgroup set; '' where unused.

    A cell is a number. The cells of a rule of ``allowed`` and a set are a block of neighbouring numbers, whose
    digits, in mixed radix, are the ranks of the values in the dictionary of each column: a range is spread
    over the cluster, cut into digits, and each digit is joined to its dictionary. A rule's block counts legal
    values only, so no illegal cell is made; a cell that an earlier rule allows too is left to that rule.
    """
    rules = list(allowed or [])
    subgroups = [c for c in ordered_union(subgroup_sets) if c not in basic]
    columns = [*basic, *subgroups]
    ids = _set_ids(subgroup_sets, subgroups)
    dictionary, sizes = column_dictionaries(df, columns, subgroups, domains, rules)

    blocks = []  # rule, set, first number, radix and stride of each column
    first = 0
    for rule in range(max(1, len(rules))):
        for number, used in zip(ids, subgroup_sets):
            radix, cells, strides = [], 1, []
            for place, column in enumerate(columns):
                if column in basic or column in used:
                    n = sizes.get((place, _rule_key(rules, rule, column)), 0)
                    radix.append(n)
                else:
                    n = int(not rules or column not in rules[rule] or "" in rules[rule][column])
                    radix.append(0)
                strides.append(cells)
                cells *= n
            if cells:
                blocks.append((rule, number, first, radix, strides))
                first += cells
    if first >= 1 << 63:
        raise ValueError(f"{first} cells are more than a table can number")

    def of_block(values: Sequence[int], kind: str = "bigint") -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values or [0]]), F.col("__block"))

    firsts = F.array(*[F.lit(b[2]).cast("bigint") for b in blocks or [(0, 0, 0)]])
    cells = df.sparkSession.range(first).withColumn("__block", F.size(F.filter(firsts, lambda low: low <= F.col("id"))))
    cells = cells.select(
        F.col("id") - of_block([b[2] for b in blocks]),
        of_block([b[0] for b in blocks], "int").alias("__rule_no"), of_block([b[1] for b in blocks], "int").alias(_SET), "__block",
    ).toDF("__cell", "__rule_no", _SET, "__block")
    digits = {}
    for place in range(len(columns)):
        radix = of_block([b[3][place] for b in blocks])
        stride = of_block([b[4][place] for b in blocks])
        digits[f"__d{place}"] = F.when(radix > 0, F.pmod(F.call_function("div", F.col("__cell"), stride), radix))
    cells = cells.select("__rule_no", _SET, *[d.alias(n) for n, d in digits.items()])
    for place, column in enumerate(columns):
        named = [i for i in range(len(rules)) if column in rules[i]]
        which = F.when(F.col("__rule_no").isin(*named), F.col("__rule_no")).otherwise(F.lit(-1)) if named else F.lit(-1)
        values = dictionary.where(F.col("__c") == place).select(
            F.col("__rule").alias("__r"), F.col("__rank").alias("__k"), F.col(f"__v{place}").alias(column)
        )
        cells = cells.withColumn("__which", which).join(
            values, (F.col("__which") == F.col("__r")) & (F.col(f"__d{place}") == F.col("__k")), "left"
        ).drop("__which", "__r", "__k", f"__d{place}")
        if column in subgroups:
            cells = cells.withColumn(column, F.coalesce(column, F.lit("")))
    for i in range(1, len(rules)):
        cells = cells.where((F.col("__rule_no") != i) | ~combination_mask(rules[:i]))
    return cells.select(*columns, _SET)


def zero_filled_counts(
    df: DataFrame,
    basic: Sequence[str],
    subgroup_sets: Sequence[Sequence[str]],
    id_column: str,
    name: str = "Counts",
    domains: Mapping[str, Sequence[Any]] | None = None,
    allowed: Sequence[Mapping[str, Sequence[Any]]] | None = None,
    total_flag: str | None = None,
) -> DataFrame:
    """Counts for each cell of the scaffold; a combination nobody fell into shows 0.

    ``allowed`` limits the cells to legal code combinations (see ``filters.combination_mask``); it is
    applied before the join. Values and counts both come from one written table of finest counts, so
    the facts are read once.
    """
    fine = materialise(finest_counts(df, ordered_union([basic, *subgroup_sets]), id_column), "finest-counts")
    return _zero_filled(fine, basic, subgroup_sets, name, domains, allowed, total_flag)


def _zero_filled(fine, basic, subgroup_sets, name, domains, allowed, total_flag) -> DataFrame:
    cells = cross_scaffold(fine, basic, subgroup_sets, domains, allowed)
    distinct_sets = list({frozenset(s): list(s) for s in subgroup_sets}.values())
    keys = [*basic, *[c for c in ordered_union(subgroup_sets) if c not in basic], _SET]
    # The subgroup order, and so the set IDs, must be those of the cells.
    counted = _roll(fine, basic, _in_order(distinct_sets, subgroup_sets, basic))
    filled = cells.join(counted, keys, "left").withColumn(_N, F.coalesce(_N, F.lit(0)))
    return _publish_rollup(filled, basic, subgroup_sets, name, total_flag)


def _in_order(distinct_sets, subgroup_sets, basic) -> list[list[str]]:
    rank = {c: i for i, c in enumerate(c for c in ordered_union(subgroup_sets) if c not in basic)}
    return [sorted((c for c in s if c not in basic), key=rank.__getitem__) for s in distinct_sets]


def _rolled_levels(
    fine: DataFrame, kinds: Mapping[str, Sequence[str]], subgroup_sets: Sequence[Sequence[str]], levels: Mapping[str, str | None],
    bits: str | None = None,
) -> DataFrame:
    """Sums for all kinds (kind -> basic columns), levels and sets in one aggregation of the finest counts.

    Rows ``__kind, __level, __entity`` (text, '' for the whole table), all basic columns (null where the kind
    has no such column), subgroups, ``__n`` and ``__set``. Bit i of the column ``bits`` says whether a row
    counts for the i-th kind; without it every row counts for all.
    """
    every_basic = ordered_union(list(kinds.values()))
    marks = []
    for i, kind in enumerate(kinds):
        held = F.col(bits).bitwiseAND(F.lit(1 << i)) != 0 if bits else F.lit(True)
        for level, entity in levels.items():
            shown = F.col(entity).cast("string") if entity else F.lit("")
            marks.append(F.when(held & shown.isNotNull(), F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), shown.alias("entity"))))
    tagged = fine.withColumn("__at", F.explode(F.array_compact(F.array(*marks))))
    tagged = tagged.select(
        "*", *[F.col(f"__at.{c}").alias(f"__{c}") for c in ("kind", "level", "entity")]
    )
    used = {c: [kind for kind, basic in kinds.items() if c in basic] for c in every_basic}
    for c, having in used.items():
        inside = F.col("__kind").isin(*having)
        tagged = tagged.where(~inside | F.col(c).isNotNull()).withColumn(c, F.when(inside, F.col(c)))
    subgroups = [c for c in ordered_union(subgroup_sets) if c not in every_basic]
    keys = ["__kind", "__level", "__entity", *every_basic]
    unused = {c: f"__unused_{i}" for i, c in enumerate(subgroups)}
    sets = [[*keys, *[c for c in s if c not in every_basic]] for s in subgroup_sets]
    rolled = tagged.groupingSets(sets, *keys, *subgroups).agg(
        F.sum(_N).alias(_N), *[F.grouping(c).alias(u) for c, u in unused.items()]
    )
    set_id, shown = F.lit(0), []
    for i, (c, u) in enumerate(unused.items()):
        rolled = rolled.where((F.col(u) == 1) | F.col(c).isNotNull())
        set_id = set_id + F.col(u).cast("int") * (1 << (len(subgroups) - 1 - i))
        shown.append(F.when(F.col(u) == 1, F.lit("")).otherwise(F.col(c).cast("string")).alias(c))
    return rolled.select(*keys, *shown, _N, set_id.alias(_SET))


def rollup_of_views(
    df: DataFrame,
    kinds: Mapping[str, Sequence[str]],
    subgroup_sets: Sequence[Sequence[str]],
    id_column: str,
    levels: Mapping[str, str | None],
    views: Mapping[str, Column] | None = None,
    name: str = "Counts",
    domains: Mapping[str, Mapping[str, Sequence[Any]] | None] | None = None,
    allowed: Mapping[str, Sequence[Mapping[str, Sequence[Any]]] | None] | None = None,
    total_flag: str | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """kind -> level -> counts, for several kinds with basic columns of their own, from one pass over the facts.

    ``views`` says which rows a kind counts (all, where it is not named; an unknown condition leaves the row
    out). Each row gets a bit for every view that it belongs to, and is counted once at the finest grain of
    all kinds, levels and sets, the bits included. That small table is written, and one aggregation sums it
    for all kinds, levels and sets. A level without an entity is zero-filled over the values that its own
    kind holds. Subgroups that are a basic column of any kind are left to the basic columns.
    """
    views, domains, allowed = views or {}, domains or {}, allowed or {}
    if len(kinds) > 62:
        raise ValueError("more than 62 kinds do not fit the bits of one column")
    every_basic = ordered_union(list(kinds.values()))
    shared = [c for c in ordered_union(subgroup_sets) if c in every_basic and any(c not in b for b in kinds.values())]
    if shared:
        raise ValueError(f"a subgroup of one kind is a basic column of another: {shared}")
    bits = F.lit(0).cast("bigint")
    for i, kind in enumerate(kinds):
        if kind in views:
            bits = bits + F.when(views[kind], F.lit(1 << i)).otherwise(F.lit(0))
        else:
            bits = bits + F.lit(1 << i)
    entities = [c for c in levels.values() if c]
    columns = ordered_union([entities, every_basic, *subgroup_sets])
    tagged = df.select(*columns, id_column, bits.alias("__views")).where("__views <> 0")
    fine = materialise(finest_counts(tagged, [*columns, "__views"], id_column), "finest-counts")
    rolled = materialise(_rolled_levels(fine, kinds, subgroup_sets, levels, "__views"), "rolled")
    out: dict[str, dict[str, DataFrame]] = {}
    for i, (kind, basic) in enumerate(kinds.items()):
        subgroups = [c for c in ordered_union(subgroup_sets) if c not in basic]
        out[kind] = {}
        for level, entity in levels.items():
            here = rolled.where((F.col("__kind") == kind) & (F.col("__level") == level))
            if entity:
                table = here.select(F.col("__entity").alias(entity), *basic, *subgroups, _N, _SET)
                shown = [entity, *basic]
            else:
                mine = fine.where(F.col("__views").bitwiseAND(F.lit(1 << i)) != 0)
                cells = cross_scaffold(mine, basic, subgroup_sets, domains.get(kind), allowed.get(kind))
                counted = here.select(*basic, *subgroups, _SET, _N)
                if len({frozenset(s) for s in subgroup_sets}) < len(subgroup_sets):
                    counted = counted.distinct()  # a set listed twice has its cells twice, not its counts
                table = cells.join(counted, [*basic, *subgroups, _SET], "left").withColumn(_N, F.coalesce(_N, F.lit(0)))
                table, shown = table.select(*basic, *subgroups, _N, _SET), basic
            out[kind][level] = _publish_rollup(table, shown, subgroup_sets, name, total_flag)
    return out


def multi_level_rollup(
    df: DataFrame,
    basic: Sequence[str],
    subgroup_sets: Sequence[Sequence[str]],
    id_column: str,
    levels: Mapping[str, str | None],
    name: str = "Counts",
    domains: Mapping[str, Sequence[Any]] | None = None,
    allowed: Sequence[Mapping[str, Sequence[Any]]] | None = None,
    total_flag: str | None = None,
) -> dict[str, DataFrame]:
    """The rollup at several levels: level -> entity column, or None for the whole table, which is
    zero-filled. All levels are sums over one written table of finest counts."""
    entities = [c for c in levels.values() if c]
    fine = materialise(finest_counts(df, ordered_union([entities, basic, *subgroup_sets]), id_column), "finest-counts")
    out = {}
    for level, entity in levels.items():
        if entity:
            rolled = _roll(fine, [entity, *basic], subgroup_sets)
            out[level] = _publish_rollup(rolled, [entity, *basic], subgroup_sets, name, total_flag)
        else:
            out[level] = _zero_filled(fine, basic, subgroup_sets, name, domains, allowed, total_flag)
    return out
