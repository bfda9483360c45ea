"""Secrets in texts by patterns and by a battery of randomness tests, with SQL functions only.

Patterns: assignments to names like password, access keys, long hexadecimal runs. The battery looks at every run of at
least ``shortest`` characters that keys are written in. It infers the encoding from the characters that occur (decimal,
hexadecimal, base 32, letters and digits of one case or of both, base 64), and tests the run against a random one over
that alphabet:

- chi-squared for uniform use of the alphabet,
- a runs test on the upper and lower half of the alphabet,
- the serial correlation of neighbouring symbols.

A run that fails the latter two at ``structure`` is no secret. For the rest the chi-squared value gives the probability of
lying as low in ordinary writing, whose symbols are used unevenly: there its mean grows by ``unevenness`` with every
character, so longer runs give smaller probabilities. Narrow alphabets, which writing uses almost evenly, say little by that.
So in runs of several classes (small letters, capitals, digits) the changes of class are counted, a capital before a small
letter excepted: words, numbers and names put together from them change at a share ``mixing`` of the places, random runs at
0.3 to 0.5. Both probabilities are combined by Fisher's method. Random digits alone can't be told from a long number, and
are reported from about 270 on. The probabilities are controlled for false discoveries within the document
(Benjamini-Hochberg at ``rate``) with weights in proportion to length, so that short runs must show more.

Positions are code points, the end exclusive. They come from cutting a text at its matches and adding up lengths, in two
levels, so a text with very many matches stays cheap. Null texts count as empty; a text without matches has empty arrays;
repeated rows give repeated results; an empty table gives an empty result; columns of other names are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, free_name

# The patterns of the contract.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
#: The value of a matched assignment: what follows its name, sign and quotes.
VALUE_AFTER = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest on: the characters that may occur, and the alphabet in its order.
ENCODINGS = (
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[a-z2-7]+$", LOWER + "234567"),
    (r"^[0-9a-z]+$", DIGITS + LOWER),
    (r"^[0-9A-Z]+$", DIGITS + UPPER),
    (r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    (r"^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    (r"^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    (r"", UPPER + LOWER + DIGITS + "+/_-"),
)
#: A place where the class changes, and a run that has several classes.
CHANGE = r"(?<=[a-z])(?=[0-9A-Z])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
SEVERAL = r"[a-z].*[0-9A-Z]|[A-Z].*[0-9a-z]|[0-9].*[A-Za-z]"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Battery:
    """``unevenness``: the sum of squared symbol frequencies of ordinary writing, with what it varies by for a character;
    ``mixing``: the share of places where writing changes its class, and ``spread`` by how much more than chance it varies;
    ``step``: matches whose positions are added up together."""

    shortest: int = 20
    structure: float = 0.001
    rate: float = 0.01
    unevenness: float = 0.068
    mixing: float = 0.15
    spread: float = 1.5
    step: int = 256


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def placed(text: Column, pattern: str, step: int) -> Column:
    """Every match with its start in code points: array<struct<start,value>>, in order."""
    none = F.array().cast("array<struct<start:int,value:string>>")

    def add(state: Column, one: Column) -> Column:
        start = state["at"] + one["before"]
        found = F.array(F.struct(start.alias("start"), one["value"].alias("value")))
        return F.struct((start + one["long"]).alias("at"), F.concat(state["found"], found).alias("found"))

    def join(state: Column, group: Column) -> Column:
        moved = F.transform(group["found"], lambda x: F.struct((state["at"] + x["start"]).alias("start"), x["value"].alias("value")))
        return F.struct((state["at"] + group["at"]).alias("at"), F.concat(state["found"], F.array(moved)).alias("found"))

    def starts(cut: Column) -> Column:
        """Positions within groups of ``step`` matches, then the groups are moved by the lengths of those before."""
        lengths = F.transform(
            cut["matches"], lambda m, i: F.struct(F.length(cut["pieces"][i]).alias("before"), F.length(m).alias("long"), m.alias("value"))
        )
        last = F.floor((F.size(cut["matches"]) - 1) / step).cast("int")
        groups = bound(lengths, lambda x: F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(x, g * step + 1, F.lit(step))))
        within = F.transform(groups, lambda g: F.aggregate(g, F.struct(F.lit(0).alias("at"), none.alias("found")), add))
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,value:string>>>").alias("found"))
        return F.aggregate(within, nothing, join, lambda state: F.flatten(state["found"]))

    def cut(matches: Column) -> Column:
        both = F.struct(matches.alias("matches"), F.split(text, pattern, -1).alias("pieces"))
        return F.when(F.size(matches) > 0, bound(both, starts)).otherwise(none)

    return bound(F.regexp_extract_all(text, F.lit(pattern), 0), cut)


def inside(outer: Column, pattern: str, step: int) -> Column:
    """Matches within the values of placed matches, as placed matches of the text."""
    found = F.filter(outer, lambda o: F.rlike(o["value"], F.lit(pattern)))
    return F.flatten(
        F.transform(
            found,
            lambda o: F.transform(
                placed(o["value"], pattern, step), lambda m: F.struct((o["start"] + m["start"]).alias("start"), m["value"].alias("value"))
            ),
        )
    )


def spans_of(kind: str, found: Column) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["value"])).alias("end"), m["value"].alias("value")
        ),
    )


def reach_before(spans: Column, end_of: Callable[[Column], Column], step: int) -> Column:
    """For each element of an array the largest ``end_of`` of those before it, 0 for the first; in groups of ``step``."""

    def largest(values: Column) -> Column:
        return F.coalesce(F.array_max(values), F.lit(0))

    def grouped(ends: Column) -> Column:
        last = F.floor((F.size(ends) - 1) / step).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(ends, g * step + 1, F.lit(step)))

    def joined(groups: Column) -> Column:
        return bound(
            F.transform(groups, largest),
            lambda tops: F.flatten(
                F.transform(
                    groups,
                    lambda group, g: bound(
                        largest(F.slice(tops, F.lit(1), g)),
                        lambda before: F.transform(group, lambda _, i: F.greatest(before, largest(F.slice(group, F.lit(1), i)))),
                    ),
                )
            ),
        )

    ends = F.transform(spans, end_of)
    return F.when(F.size(spans) > 0, bound(bound(ends, grouped), joined)).otherwise(F.array().cast("array<int>"))


def outside(runs: Column, base: Column, step: int) -> Column:
    """The spans of ``runs`` that lie within no span of ``base``: one pass over both in the order of their starts."""
    event = lambda s, last, own: F.struct(s["start"].alias("start"), F.lit(last).alias("last"), s["end"].alias("end"), own.alias("span"))
    nothing = F.lit(None).cast("struct<kind:string,start:int,end:int,value:string>")
    both = F.concat(F.transform(base, lambda s: event(s, 0, nothing)), F.transform(runs, lambda s: event(s, 1, s)))

    def kept(ordered: Column) -> Column:
        reach = reach_before(ordered, lambda e: F.when(e["last"] == 0, e["end"]).otherwise(0), step)
        marked = F.zip_with(ordered, reach, lambda e, r: F.struct(e["span"].alias("span"), (e["end"] <= r).alias("covered")))
        return F.transform(F.filter(marked, lambda m: m["span"].isNotNull() & ~m["covered"]), lambda m: m["span"])

    return F.when(F.size(runs) > 0, bound(F.array_sort(both), kept)).otherwise(runs)


def normal_below(z: Column) -> Column:
    """The standard normal distribution function, by its logistic approximation of third degree."""
    return 1 / (1 + F.exp(-z * (1.5976 + 0.07056 * z * z)))


def tested(value: Column, battery: Battery) -> Column:
    """struct<p, structured> of one run: how likely ordinary writing looks as random, and whether its order betrays it."""
    kind = F.lit(len(ENCODINGS) - 1)
    for i, (characters, _) in reversed(list(enumerate(ENCODINGS))[:-1]):
        kind = F.when(F.rlike(value, F.lit(characters)), F.lit(i)).otherwise(kind)

    def per_kind(kind: Column, make: Callable[[str], Column]) -> Column:
        chosen = make(ENCODINGS[-1][1])
        for i, (_, alphabet) in reversed(list(enumerate(ENCODINGS))[:-1]):
            chosen = F.when(kind == i, make(alphabet)).otherwise(chosen)
        return chosen

    def halves(alphabet: str) -> Column:
        half = len(alphabet) // 2
        return F.translate(value, alphabet, "0" * half + "1" * (len(alphabet) - half))

    def prepared(kind: Column) -> Column:
        symbols = F.filter(F.split(value, ""), lambda s: s != "")
        return F.struct(
            F.length(value).cast("double").alias("n"),
            per_kind(kind, lambda a: F.lit(float(len(a)))).alias("k"),
            per_kind(kind, halves).alias("halves"),
            symbols.alias("symbols"),
            bound(per_kind(kind, F.lit), lambda a: F.transform(symbols, lambda s: F.instr(a, s).cast("double"))).alias("places"),
        )

    def total(values: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + of(x))

    def summed(x: Column) -> Column:
        n = x["n"]
        return F.struct(
            x.alias("x"),
            total(F.array_distinct(x["symbols"]), lambda s: F.pow(n - F.length(F.replace(value, s, F.lit(""))), F.lit(2.0))).alias("squares"),
            F.length(F.replace(x["halves"], F.lit("0"), F.lit(""))).cast("double").alias("ones"),
            F.length(F.regexp_replace(x["halves"], r"(.)\1*+", "x")).cast("double").alias("runs"),
            (total(x["places"], lambda v: v) / n).alias("mean"),
            F.regexp_count(value, F.lit(CHANGE)).cast("double").alias("changes"),
        )

    def judged(y: Column) -> Column:
        n, k, ones, mean, places = y["x"]["n"], y["x"]["k"], y["ones"], y["mean"], y["x"]["places"]
        # chi-squared, and what it is in ordinary writing
        chi = y["squares"] * k / n - n
        excess = F.greatest(k * battery.unevenness - 1, F.lit(0.1))
        variance = 2 * (k - 1) + 4 * (n - 1) * excess * (1 + excess)
        p_even = normal_below((chi - (k - 1) - (n - 1) * excess) / F.sqrt(variance))
        # changes of class, which writing has few of
        rate, places_between = battery.mixing, n - 1
        varies = F.sqrt(places_between * (rate * (1 - rate) * battery.spread))
        p_mixed = normal_below((places_between * rate + 0.5 - y["changes"]) / varies)
        both = F.greatest(p_even * p_mixed, F.lit(1e-300))
        p = F.when(F.rlike(value, F.lit(SEVERAL)), both * (1 - F.log(both))).otherwise(p_even)
        # runs of the two halves, and how evenly these are used
        pairs = 2 * ones * (n - ones) / n
        spread = F.greatest(pairs * (pairs - 1) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-9))
        z_runs = F.when(pairs == 0, F.lit(9.0)).otherwise(F.abs(y["runs"] - 1 - pairs) / F.sqrt(spread))
        z_halves = F.abs(ones - n * (k - F.floor(k / 2)) / k) / F.sqrt(n / 4)
        # correlation of each symbol's place in the alphabet with the next one's
        next_to = total(
            F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1), F.slice(places, F.lit(2), F.size(places) - 1), lambda a, b: (a - mean) * (b - mean)),
            lambda v: v,
        )
        apart = F.greatest(total(places, lambda v: (v - mean) * (v - mean)), F.lit(1e-9))
        z_serial = F.abs(next_to / apart + 1 / n) * F.sqrt(n)
        worst = F.greatest(z_runs, z_serial, z_halves)
        return F.struct(p.alias("p"), (6 * (1 - normal_below(worst)) < battery.structure).alias("structured"))

    return bound(bound(bound(kind, prepared), summed), judged)


def discovered(runs: Column, battery: Battery) -> Column:
    """The runs that stay after length-weighted control of false discoveries over all runs of the text."""

    def weighed(tests: Column) -> Column:
        long = F.aggregate(tests, F.lit(0.0), lambda a, m: a + F.length(m["value"])) / F.size(tests)
        return bound(
            long,
            lambda mean: F.array_sort(
                F.transform(
                    tests,
                    lambda m: F.struct(
                        F.when(m["test"]["structured"], F.lit(1e9)).otherwise(m["test"]["p"] * mean / F.length(m["value"])).alias("p"),
                        m["start"].alias("start"),
                        m["value"].alias("value"),
                    ),
                )
            ),
        )

    def passed(ranked: Column) -> Column:
        last = F.array_max(F.transform(ranked, lambda m, i: F.when(m["p"] <= battery.rate * (i + 1) / F.size(ranked), i + 1).otherwise(0)))
        return F.transform(F.slice(ranked, F.lit(1), last), lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value")))

    tests = F.transform(runs, lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value"), tested(m["value"], battery).alias("test")))
    return F.when(F.size(runs) > 0, bound(bound(tests, weighed), passed)).otherwise(F.array().cast("array<struct<start:int,value:string>>"))


def secret_spans(documents: DataFrame, text: str = "text", into: str = "spans", battery: Battery = Battery()) -> DataFrame:
    """``documents`` with the column ``into``: all spans (kind, start, end, value) by start, then kind as listed in KINDS.

    A random run is added only where it is not within a span of a pattern.
    """
    step = battery.step
    value = F.coalesce(col(text), F.lit(""))
    names = [free_name(documents, n) for n in ("assigns_", "runs_", "base_")]
    assigns, runs, base = (F.col(n) for n in names)
    short = F.array().cast("array<struct<start:int,value:string>>")
    found = documents.withColumn(
        names[0],
        F.when(
            F.rlike(value, F.lit(ASSIGN)),
            F.filter(placed(value, ASSIGN, step), lambda m: F.length(F.regexp_extract(m["value"], VALUE_AFTER, 1)) >= 6),
        ).otherwise(short),
    ).withColumn(names[1], placed(value, rf"[A-Za-z0-9+/_-]{{{battery.shortest},}}", step))
    patterns = F.concat(
        spans_of("assign", assigns), spans_of("access", inside(runs, ACCESS, step)), spans_of("hex", inside(runs, HEX, step))
    )
    found = found.withColumn(names[2], patterns)
    added = outside(spans_of("random", discovered(runs, battery)), base, step)
    kinds = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        F.concat(base, added),
        lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("kind"), s.alias("span")),
    )
    every = F.transform(F.array_sort(keyed), lambda x: x["span"])
    return found.withColumn(into, every.cast(SPAN)).drop(*names)


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, instead: str = "[SECRET]", step: int = 256, chunk: int = 1024) -> Column:
    """``text`` with every span replaced, overlapping ones together; ``spans`` in the order of their starts.

    The text is cut into chunks of ``chunk`` code points once, so that taking what lies between two spans looks at two chunks
    and joins those between them.
    """

    def between(chunks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / chunk).cast("int"), F.floor(end / chunk).cast("int")
        part = lambda n, at, size: F.coalesce(F.substring(F.get(chunks, n), at, size), F.lit(""))
        return F.when(first == last, part(first, start % chunk + 1, end - start)).otherwise(
            F.concat(
                part(first, start % chunk + 1, F.lit(chunk)),
                F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                part(last, F.lit(1), end % chunk),
            )
        )

    def joined(chunks: Column) -> Column:
        def parts(reach: Column) -> Column:
            one = lambda span, before: F.when(
                span["start"] >= before, F.concat(between(chunks, before, span["start"]), F.lit(instead))
            ).otherwise("")
            end = F.greatest(F.element_at(reach, -1), F.element_at(spans, -1)["end"])
            return F.concat(F.array_join(F.zip_with(spans, reach, one), ""), between(chunks, end, F.length(text)))

        return bound(reach_before(spans, lambda s: s["end"], step), parts)

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, bound(chunks, joined)).otherwise(text)
