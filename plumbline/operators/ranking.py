"""Cut hash-ordered rows at exact positions without sorting the table.

Rows are ordered by the hex digits of a hash. Counting rows per hash prefix tells which prefix
holds a wanted position; counting again inside that one prefix narrows it further. Only the last,
short prefix is ranked. What comes back is one boundary hash per cut, so placing a row is a string
comparison in a projection: the table itself is never shuffled, joined or windowed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS_PER_PASS = 3
HASH_DIGITS = 64  # 32 of the key, 32 of the content
EDGE_ROWS = 200_000  # a prefix this small is ranked in one task

_BEFORE_ALL = ""
_AFTER_ALL = "g"


def key_text(key_cols: Sequence[str]) -> Column:
    """One text per key: the value of a single column, else values with their lengths, NULL apart."""
    texts = [F.col(f"`{c}`").cast("string") for c in key_cols]
    if len(texts) == 1:
        return F.coalesce(texts[0], F.lit("\0"))
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def content_hash(df: DataFrame) -> Column:
    """md5 of all columns of a row."""
    return F.md5(F.concat(key_text(df.columns), F.lit("")))


def hash_order(salt: str, seed: int, key_cols: Sequence[str], content: Column | None = None) -> Column:
    """md5 of ``salt:seed:key`` in hex, then the hash of the row's content, which sets rows of one key
    apart."""
    own = F.md5(F.concat(F.lit(f"{salt}:{seed}:"), key_text(key_cols)))
    return own if content is None else F.concat(own, content)


def boundaries(
    df: DataFrame,
    order: Column,
    group: Column,
    cuts_of: Callable[[dict[int, int]], dict[int, list[int]]],
    edge_rows: int = EDGE_ROWS,
) -> dict[int, list[str]]:
    """The hash of the last row before each cut, per group.

    ``cuts_of`` gets the rows per group and returns the wanted positions per group. ``group`` must
    have few values (the classes): the first pass returns at most 4096 counts for each of them.
    """
    rows = df.select(group.alias("g"), order.alias("h"))
    digits = DIGITS_PER_PASS
    counts: dict[int, dict[str, int]] = {}
    for r in _prefix_counts(rows, digits).collect():
        counts.setdefault(r["g"], {})[r["p"]] = r["n"]
    sizes = {g: sum(c.values()) for g, c in counts.items()}
    found: dict[tuple[int, int], str] = {}
    open_cuts: dict[tuple[int, int], tuple[str, int, int]] = {}
    wanted = cuts_of(sizes)
    for g, positions in wanted.items():
        for position in positions:
            if position <= 0:
                found[g, position] = _BEFORE_ALL
            elif position >= sizes.get(g, 0):
                found[g, position] = _AFTER_ALL
            else:
                open_cuts[g, position] = _locate(counts[g], position)
    while open_cuts and max(n for _, _, n in open_cuts.values()) > edge_rows:
        digits += DIGITS_PER_PASS
        if digits > HASH_DIGITS:
            raise ValueError("copies of one row fill a whole edge of a cut: give them a key with with_row_key")
        finer: dict[tuple[int, str], dict[str, int]] = {}
        for r in _prefix_counts(_inside(rows, open_cuts), digits).collect():
            finer.setdefault((r["g"], r["p"][: digits - DIGITS_PER_PASS]), {})[r["p"]] = r["n"]
        open_cuts = {
            (g, position): _locate(finer[g, prefix], rest)
            for (g, position), (prefix, rest, _) in open_cuts.items()
        }
    if open_cuts:
        found |= _rank_edges(rows, open_cuts, digits)
    return {g: [found[g, position] for position in positions] for g, positions in wanted.items()}


def with_part(
    df: DataFrame, order: Column, group: Column, bounds: dict[int, list[str]], output: str, rows: Column | None = None
) -> DataFrame:
    """Add the number of cuts a row lies behind: 0 before the first, K-1 behind the last of K-1.

    With ``rows`` the column is NULL where that condition does not hold.
    """
    hashed = df.withColumn("__h", order)  # a column of its own, so it is computed once per row
    part = F.lit(None).cast("int")
    for g, hashes in sorted(bounds.items()):
        behind = F.lit(0)
        for h in hashes:
            behind = behind + (F.col("__h") > F.lit(h)).cast("int")
        part = F.when(group == g, behind).otherwise(part)
    return hashed.withColumn(output, part if rows is None else F.when(rows, part)).drop("__h")


def _prefix_counts(rows: DataFrame, digits: int) -> DataFrame:
    return rows.groupBy("g", F.substring("h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def _locate(counts: dict[str, int], position: int) -> tuple[str, int, int]:
    """(prefix, position inside it, rows in it) for a 1-based position."""
    before = 0
    for prefix in sorted(counts):
        if before + counts[prefix] >= position:
            return prefix, position - before, counts[prefix]
        before += counts[prefix]
    raise AssertionError("position behind the last row")


def _inside(rows: DataFrame, open_cuts: dict[tuple[int, int], tuple[str, int, int]]) -> DataFrame:
    """Rows whose group and prefix hold a cut. All prefixes are equally long, so one look-up per row tells,
    and its hash is made once for it instead of once per cut."""
    wanted = sorted({(g, prefix) for (g, _), (prefix, _, _) in open_cuts.items()})
    start = F.substring("h", 1, len(wanted[0][1]))
    return rows.where(F.concat(F.col("g").cast("string"), F.lit(":"), start).isin([f"{g}:{prefix}" for g, prefix in wanted]))


def _rank_edges(rows: DataFrame, open_cuts, digits: int) -> dict[tuple[int, int], str]:
    edge = Window.partitionBy("g", "p").orderBy("h")
    ranked = (
        _inside(rows, open_cuts)
        .withColumn("p", F.substring("h", 1, digits))
        .withColumn("i", F.row_number().over(edge))
    )
    near = F.lit(False)
    for (g, _), (prefix, rest, _) in open_cuts.items():
        near = near | ((F.col("g") == g) & (F.col("p") == prefix) & F.col("i").isin(rest, rest + 1))
    at = {(r["g"], r["p"], r["i"]): r["h"] for r in ranked.where(near).select("g", "p", "i", "h").collect()}
    found = {}
    for (g, position), (prefix, rest, _) in open_cuts.items():
        last = at[g, prefix, rest]
        if at.get((g, prefix, rest + 1)) == last:
            raise ValueError("copies of one row lie on both sides of a cut: give them a key with with_row_key")
        found[g, position] = last
    return found
