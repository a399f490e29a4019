"""Spans of regular expressions in whole texts, with built-in functions only.

Positions are code points from 0, end exclusive. Matches are leftmost and non-overlapping; the texts between matches give
their positions. Patterns must not match the empty string, and are written so that a long run is read once (possessive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def with_spans(df: DataFrame, text: str, rules: list[tuple[str, str, Column | None, object]], out: str) -> DataFrame:
    """``df`` with ``out``: an array of SPAN, ordered by start and then by rule.

    A rule is (kind, pattern, cheap test that is false only where nothing matches, test of a match's text).
    The steps are separate projections, since each of them is used more than once by the next.
    """
    keep = df.columns
    quoted = [F.col(f"`{c}`") for c in keep]
    may = lambda t, p: F.col(text).rlike(p) if t is None else t & F.col(text).rlike(p)
    found = df.select(*quoted, *[F.when(may(t, p), F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0))).alias(f"{out}_m{i}") for i, (_, p, t, _) in enumerate(rules)])
    columns = [*found.columns]
    found = found.select(*[F.col(f"`{c}`") for c in columns], *[F.when(F.col(f"{out}_m{i}").isNotNull(), F.split(F.col(text), p, -1)).alias(f"{out}_g{i}") for i, (_, p, _, _) in enumerate(rules)])
    columns = [*found.columns]
    found = found.select(*[F.col(f"`{c}`") for c in columns], *[_lengths(F.col(f"{out}_m{i}"), F.col(f"{out}_g{i}")).alias(f"{out}_l{i}") for i in range(len(rules))])
    parts = [_rule_spans(F.col(f"{out}_m{i}"), F.col(f"{out}_g{i}"), F.col(f"{out}_l{i}"), i, kind, valid) for i, (kind, _, _, valid) in enumerate(rules)]
    return found.select(*quoted, F.array_sort(F.concat(*parts)).alias(out))


# A fold copies what it has collected with each step, so it works in blocks of this many entries, whose results it sets aside.
BLOCK = 256


def collecting(array: Column, state: dict[str, Column], of: str, step, enter=None, leave=None, finish=None) -> Column:
    """A fold over ``array``, a column of its own, that collects values of type ``of``: n / BLOCK folds of BLOCK steps.

    ``step(acc, x)`` gives (next state, array of values). ``enter(acc, entries)`` gives the state within a block, ``leave(acc, inner)`` the one
    after it, the same by default. ``finish(acc, values)`` gives the result, the values alone by default.
    """
    last = F.floor((F.size(array) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(array, i * BLOCK + 1, BLOCK))
    none = F.array().cast(f"array<{of}>")
    first = F.struct(*[v.alias(k) for k, v in state.items()], F.array().cast(f"array<array<{of}>>").alias("done"))

    def merge(acc: Column, x: Column) -> Column:
        after, values = step(acc, x)
        return F.struct(*[after[k].alias(k) for k in state], F.concat(acc["kept"], values).alias("kept"))

    def block(acc: Column, entries: Column) -> Column:
        def end(x: Column) -> Column:
            after = leave(acc, x) if leave else {k: x[k] for k in state}
            return F.struct(*[after[k].alias(k) for k in state], F.concat(acc["done"], F.array(x["kept"])).alias("done"))

        inside = enter(acc, entries) if enter else {k: acc[k] for k in state}
        return F.aggregate(entries, F.struct(*[inside[k].alias(k) for k in state], none.alias("kept")), merge, end)

    return F.aggregate(blocks, first, block, lambda acc: finish(acc, F.flatten(acc["done"])) if finish else F.flatten(acc["done"]))


def sums_before(array: Column) -> Column:
    """The sum of all entries of an array of longs before each entry."""
    return collecting(array, {"sum": F.lit(0).cast("long")}, "bigint", lambda acc, x: ({"sum": acc["sum"] + x}, F.array(acc["sum"])))


def _lengths(m: Column, g: Column) -> Column:
    """Length of each text between matches together with the match behind it."""
    zipped = F.arrays_zip(g.alias("g"), m.alias("m"))
    return F.transform(zipped, lambda x: (F.length(x["g"]) + F.coalesce(F.length(x["m"]), F.lit(0))).cast("long"))


def _rule_spans(m: Column, g: Column, lengths: Column, rank: int, kind: str, valid) -> Column:
    """Spans of the matches ``m``, given the texts between them, ``g``."""
    placed = F.arrays_zip(sums_before(lengths).alias("b"), g.alias("g"), m.alias("m"))
    rows = F.filter(placed, lambda x: x["m"].isNotNull() & valid(x["m"]) if valid else x["m"].isNotNull())

    def span(x: Column) -> Column:
        start = x["b"] + F.length(x["g"])
        end = start + F.length(x["m"])
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("value"))

    return F.when(m.isNotNull(), F.transform(rows, span)).otherwise(no_spans())


def outside_of(spans: Column, is_base) -> Column:
    """``spans``, a column ordered by start, without those that overlap a base span; ``is_base(span)`` tells which those are.

    The others mustn't overlap one another. Each waits for the next span, which is a base span within its reach or shows that there is none.
    """
    waiting = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, s: Column) -> tuple:
        reach = F.when(is_base(s), F.greatest(acc["reach"], s["end"])).otherwise(acc["reach"])
        freed = F.filter(acc["held"], lambda h: ~is_base(s) | (h["end"] <= s["start"]))
        held = F.when(is_base(s) | (s["start"] < acc["reach"]), waiting).otherwise(F.array(s))
        return {"reach": reach, "held": held}, F.concat(freed, F.when(is_base(s), F.array(s)).otherwise(waiting))

    return collecting(spans, {"reach": F.lit(-1).cast("long"), "held": waiting}, SPAN, step, finish=lambda acc, values: F.concat(values, acc["held"]))


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def by_kind(spans: Column) -> Column:
    """The same spans ordered by rule, then by start."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"].alias("r"), s.alias("s"))))
    return F.transform(ranked, lambda x: x["s"])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def rewrite(text: Column, spans: Column, replacement) -> Column:
    """The text with each span replaced; of overlapping spans the first and longest counts. ``spans`` is ordered by start.

    ``replacement(span)`` gives a string column.
    """
    zero = F.lit(0).cast("long")

    def step(acc: Column, s: Column) -> tuple:
        taken = s["start"] >= acc["at"]
        gap = F.substring(acc["rest"], (acc["at"] - acc["first"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        new = F.when(taken, F.array(F.concat(gap, replacement(s)))).otherwise(F.array().cast("array<string>"))
        return {"first": acc["first"], "at": F.when(taken, s["end"]).otherwise(acc["at"]), "rest": acc["rest"]}, new

    # A block works on its own piece of the text, and what is left of the text begins behind it.
    def enter(acc: Column, entries: Column) -> dict:
        upto = F.array_max(F.transform(entries, lambda s: s["end"]))
        return {"first": acc["first"], "at": acc["at"], "rest": F.substring(acc["rest"], 1, (upto - acc["first"]).cast("int"))}

    def leave(acc: Column, inner: Column) -> dict:
        rest = F.substring(acc["rest"], (inner["at"] - acc["first"] + 1).cast("int"), F.length(acc["rest"]))
        return {"first": inner["at"], "at": inner["at"], "rest": rest}

    whole = collecting(spans, {"first": zero, "at": zero, "rest": text}, "string", step, enter, leave, lambda acc, values: F.concat(F.array_join(values, ""), acc["rest"]))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
