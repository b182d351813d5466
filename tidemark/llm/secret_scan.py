"""Secrets in texts by patterns and by character Markov models; DataFrame functions only.

Three patterns name secrets outright. First-order Markov models over characters find more: models of random strings, one
for each of the usual alphabets, fitted on labelled strings drawn from them, and one of ordinary identifiers, fitted on
the runs of such characters in all documents. A run whose mean log-likelihood ratio per transition reaches the threshold
of its alphabet, which held-out labelled strings give, is a secret as well, whatever stands before it. Runs are cut at
what the patterns found; in a run that is not random as a whole, stretches of its parts between separators are.

The tables of the models have one entry per pair of characters, whatever the size of the data, and enter the
plan as a literal. Texts are never shuffled, and only those that hold a run worth scoring are taken apart.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import spare

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Runs that the models score, their parts between separators, and runs that stand for ordinary identifiers in training.
RUN_CHARS = 16
RUN = f"[A-Za-z0-9+/_=-]{{{RUN_CHARS},}}"
PART = "[A-Za-z0-9+]+"
IDENTIFIER = "[A-Za-z0-9+/_=-]{8,}"
#: Characters of the models; others do not occur in runs.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Kinds of random strings: their characters, and the runs that are taken for that kind, the first that fits. Runs without
#: a letter are numbers, dates and rules, and never random.
SORTS = (
    ("number", "0123456789", "[^A-Za-z]+"),
    ("hex", "0123456789abcdef", "[0-9a-f]+"),
    ("upper hex", "0123456789ABCDEF", "[0-9A-F]+"),
    ("uuid", "0123456789abcdef-", "[0-9a-f-]+"),
    ("lower", "abcdefghijklmnopqrstuvwxyz", "[a-z]+"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[A-Z]+"),
    ("lower 36", "abcdefghijklmnopqrstuvwxyz0123456789", "[a-z0-9]+"),
    ("upper 36", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "[A-Z0-9]+"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "[A-Za-z0-9]+"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=", "[A-Za-z0-9+/=]+"),
    ("any", ALPHABET, ".*"),
)
#: Labelled random strings that are drawn of each sort, and their sizes; one in four is held out for the threshold.
DRAWN, DRAWN_CHARS = 2000, (16, 40)
#: Share of the held-out random strings that may stay below the threshold.
MISSED = 0.02
#: Bits per transition from which a run counts as random, for a single table of ratios.
THRESHOLD = 1.0
#: Bits below its best end, over the threshold, at which a stretch of parts is closed and the next begins.
DROP = 8.0
#: Share of the uniform distribution in either model, for transitions without an example.
UNIFORM = 0.2
#: Examples of the uniform distribution added after each character, so that few examples say little.
PRIOR = 16
#: Code points in a chunk of a text that is taken apart.
CHUNK = 1024


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running sum, maximum and the like of an array, by doubling the reach: as many passes as the size has bits."""

    def step(state: Column, k: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), k)
        further = lambda x, i: F.when(i >= reach, join(x, F.get(state, i - reach))).otherwise(x)
        return F.when(F.size(state) > reach, F.transform(state, further)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), values, step)


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """(start, end, kind, match) of a pattern's matches: the text between them, split out, tells where they lie."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(both: Column) -> Column:
        found, gaps = both["matches"], F.slice(both["gaps"], 1, F.size(both["matches"]))
        ends = running(F.zip_with(gaps, found, lambda g, m: F.length(g) + F.length(m)), lambda x, y: x + y)
        return F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), F.lit(kind).alias("kind"), m.alias("match")))

    found = F.get(F.transform(F.array(F.struct(matches.alias("matches"), F.split(text, pattern, -1).alias("gaps"))), placed), F.lit(0))
    return F.filter(found, keep) if keep is not None else found


def rebuilt(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with ``put(length, apart)`` in place of what each span covers beyond those before it; ``apart`` is false
    where it overlaps one of them.

    The text is cut into chunks first, so that the place of a span is found without a walk from the text's start.
    """
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def pieces(x: Column) -> Column:
        spans, done = x["spans"], x["done"]
        reached = lambda i: F.when(i > 0, F.get(done, i - 1)).otherwise(F.lit(0))

        def between(a: Column, b: Column) -> Column:
            first = (a / CHUNK).cast("int")
            held = F.slice(x["chunks"], first + 1, (b / CHUNK).cast("int") - first + 1)
            return F.when(b > a, F.substring(F.array_join(held, ""), a % CHUNK + 1, b - a)).otherwise("")

        def piece(s: Column, i: Column) -> Column:
            new = F.greatest(s["end"] - F.greatest(s["start"], reached(i)), F.lit(0))
            apart = (i == 0) | (s["start"] >= reached(i))
            return F.concat(between(reached(i), F.greatest(s["start"], reached(i))), put(new, apart))

        return F.concat(F.array_join(F.transform(spans, piece), ""), between(F.get(done, F.size(done) - 1), F.length(text)))

    # an array that a function reads many times is bound as a lambda's variable, or it is worked out each time
    with_ends = lambda x: F.struct(x["spans"], x["chunks"], running(F.transform(x["spans"], lambda s: s["end"]), F.greatest).alias("done"))
    work = F.transform(F.array(F.struct(ordered.alias("spans"), chunks.alias("chunks"))), with_ends)
    new = F.get(F.transform(work, pieces), F.lit(0))
    return F.when(F.size(spans) > 0, new).otherwise(text)


def _none() -> Column:
    return F.expr("cast(array() as array<struct<start:int,end:int,kind:int,match:string>>)")


def base_spans(text: Column) -> Column:
    """Spans of the three patterns; texts without a match are told apart by a cheaper search."""
    lower = F.lower(text)
    key = reduce(lambda a, b: a | b, (F.contains(lower, F.lit(x)) for x in ("passw", "secret", "token", "apikey", "api_key")))
    value = lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= ASSIGN_CHARS
    return F.concat(
        F.when(key, _spans(text, ASSIGN, 0, value)).otherwise(_none()),
        F.when(F.contains(text, F.lit("AKIA")), _spans(text, ACCESS, 1)).otherwise(_none()),
        F.when(text.rlike(HEX), _spans(text, HEX, 2)).otherwise(_none()),
    )


def _transitions(runs: DataFrame, weight: str) -> DataFrame:
    """(a, b, weight): how often character b follows a."""
    pairs = runs.select(weight, F.explode(F.expr("transform(sequence(1, length(run) - 1), i -> substring(run, i, 2))")).alias("pair"))
    return pairs.groupBy("pair").agg(F.sum(weight).alias("n"))


def train(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratios in bits, random over ordinary, by pair of characters of ALPHABET, row by row.

    Labels come from the patterns: the values of all matches of all documents are random strings, their other runs
    ordinary identifiers. Each distinct run counts once. With no example of either kind all ratios are 0, and nothing
    is added to the patterns.
    """
    texts = docs.select(_text(text_col).alias("text"))
    marked = texts.select("text", base_spans(F.col("text")).alias("spans")).where(F.size("spans") > 0)
    value = F.when(F.col("s.kind") == 0, F.regexp_extract("s.match", ASSIGN, 1)).otherwise(F.col("s.match"))
    positive = marked.select(F.explode("spans").alias("s")).select(value.alias("run")).where("length(run) > 1").distinct().withColumn("n", F.lit(1))
    blank = reduce(lambda t, p: F.regexp_replace(t, p, " "), (ASSIGN, ACCESS, HEX), F.col("text"))
    negative = texts.select(F.explode(F.regexp_extract_all(blank, F.lit(IDENTIFIER), F.lit(0))).alias("run")).distinct().withColumn("n", F.lit(1))
    rows = _transitions(positive, "n").withColumn("random", F.lit(1)).unionByName(_transitions(negative, "n").withColumn("random", F.lit(0))).collect()
    counts = [{}, {}]
    for r in rows:  # at most one row per pair of characters and kind
        counts[r["random"]][r["pair"]] = r["n"]
    if not counts[0] or not counts[1]:
        return [0.0] * len(ALPHABET) ** 2
    totals = [{a: sum(n for p, n in c.items() if p[0] == a) for a in ALPHABET} for c in counts]

    def chance(kind: int, a: str, b: str) -> float:
        own = (counts[kind].get(a + b, 0) + PRIOR / len(ALPHABET)) / (totals[kind][a] + PRIOR)
        return (1 - UNIFORM) * own + UNIFORM / len(ALPHABET)

    return [math.log2(chance(1, a, b) / chance(0, a, b)) for a in ALPHABET for b in ALPHABET]


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratios over the threshold, a table for every sort of random string; a run is random from 0 on."""

    tables: tuple[tuple[float, ...], ...]
    thresholds: tuple[float, ...]


def drawn(spark: SparkSession, count: int = DRAWN) -> DataFrame:
    """(sort, held, run): labelled random strings of every sort but numbers, the same at every call."""
    low, high = DRAWN_CHARS
    sorts = F.array(*[F.struct(F.lit(k).alias("sort"), F.lit(chars).alias("chars")) for k, (_, chars, _) in enumerate(SORTS) if k])
    rows = spark.range(count).select("id", F.explode(sorts).alias("s")).select("id", "s.*")
    draw = lambda i: F.substring("chars", F.pmod(F.xxhash64("id", "sort", i), F.length("chars")).cast("int") + 1, 1)
    size = F.pmod(F.xxhash64("id", "sort"), F.lit(high - low + 1)).cast("int") + low
    return rows.select("sort", (F.col("id") % 4 == 0).alias("held"), F.array_join(F.transform(F.sequence(F.lit(1), size), draw), "").alias("run"))


def fit(docs: DataFrame, text_col: str = "text") -> Models:
    """Models of random strings and of ordinary identifiers, and the thresholds between them.

    Labelled samples: random strings drawn of the usual alphabets, one model for each; as ordinary identifiers all
    distinct runs of all documents outside the patterns' matches, in their own letters and in capitals. The threshold of
    a sort is what all but MISSED of the held-out random strings of that sort reach, and never below 0, from where a
    random string is the likelier. Documents without a run give a uniform model of identifiers.
    """
    texts = docs.select(_text(text_col).alias("text"))
    blank = reduce(lambda t, p: F.regexp_replace(t, p, " "), (ASSIGN, ACCESS, HEX), F.col("text"))
    runs = texts.select(F.explode(F.regexp_extract_all(blank, F.lit(IDENTIFIER), F.lit(0))).alias("run")).distinct().withColumn("n", F.lit(1))
    plain: Counter = Counter()
    for r in _transitions(runs, "n").collect():  # at most one row per pair of characters
        plain[r["pair"]] += r["n"]
        plain[r["pair"].upper()] += r["n"]
    after = Counter()
    for pair, n in plain.items():
        after[pair[0]] += n
    strings = drawn(docs.sparkSession).collect()  # DRAWN of each sort

    def chance(counts: Counter, sums: Counter, pair: str, size: int) -> float:
        own = (counts[pair] + PRIOR / size) / (sums[pair[0]] + PRIOR)
        return (1 - UNIFORM) * own + UNIFORM / size

    tables, thresholds = [(-1.0,) * len(SORTS[0][1]) ** 2], [0.0]
    for k, (_, chars, _) in enumerate(SORTS[1:], 1):
        pairs = Counter(p for r in strings if r["sort"] == k and not r["held"] for p in map("".join, zip(r["run"], r["run"][1:], strict=False)))
        sums = Counter()
        for pair, n in pairs.items():
            sums[pair[0]] += n
        ratio = {a + b: math.log2(chance(pairs, sums, a + b, len(chars)) / chance(plain, after, a + b, len(ALPHABET))) for a in chars for b in chars}
        means = sorted(sum(ratio[a + b] for a, b in zip(r["run"], r["run"][1:], strict=False)) / (len(r["run"]) - 1) for r in strings if r["sort"] == k and r["held"])
        thresholds.append(max(0.0, means[int(MISSED * len(means))]))
        tables.append(tuple(round(ratio[a + b] - thresholds[k], 4) for a in chars for b in chars))
    return Models(tuple(tables), tuple(thresholds))


Ratios = list[float] | Models


def total(run: Column, ratios: Ratios, sort: int | None = None) -> Column:
    """Sum of the log-likelihood ratios of a run's transitions, of its own sort unless ``sort`` is given."""
    if isinstance(ratios, Models):
        rows = [{"chars": chars, "ratios": x} for (_, chars, _), x in zip(SORTS, ratios.tables, strict=True)]
        own = reduce(lambda c, k: F.when(run.rlike(f"^{SORTS[k][2]}$"), F.lit(k)).otherwise(c), reversed(range(len(SORTS) - 1)), F.lit(len(SORTS) - 1))
    else:
        rows, own = [{"chars": ALPHABET, "ratios": ratios}], F.lit(0)
    models = F.from_json(F.lit(json.dumps(rows)), "array<struct<chars:string,ratios:array<double>>>")

    def summed(m: Column) -> Column:
        numbers = F.transform(F.split(run, ""), lambda c: F.greatest(F.instr(m["chars"], c) - 1, F.lit(0)))

        def over(numbers: Column) -> Column:
            pairs = F.zip_with(F.slice(numbers, 1, F.length(run) - 1), F.slice(numbers, 2, F.length(run) - 1), lambda a, b: F.get(m["ratios"], a * F.length(m["chars"]) + b))
            return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)

        return F.get(F.transform(F.array(numbers), over), F.lit(0))

    return F.get(F.transform(F.array(F.get(models, own if sort is None else F.lit(sort))), summed), F.lit(0))


def score(run: Column, ratios: Ratios) -> Column:
    """Mean log-likelihood ratio per transition of a run; of fitted models, over the threshold."""
    return total(run, ratios) / (F.length(run) - 1)


def masked(text: Column, spans: Column) -> Column:
    """The text with spaces under the spans, so that all else keeps its place."""
    return rebuilt(text, spans, lambda n, apart: F.repeat(F.lit(" "), n))


def _stretches(run: Column, ratios: Ratios, threshold: float) -> Column:
    """Spans of consecutive parts of a run whose ratios add up to most over the threshold, from left to right.

    A part goes on with the stretch before it while their sum stays above zero and near its best; a stretch ends at its
    best part. A part that is random and long enough by itself always lies in one.
    """
    sort = len(SORTS) - 1 if isinstance(ratios, Models) else 0
    over = lambda x, sort=None: total(x, ratios, sort) - threshold * (F.length(x) - 1)

    def scored(x: Column) -> Column:
        part = lambda p, i: F.struct(p["start"].alias("start"), p["end"].alias("end"), over(p["match"]).alias("own"), over(link(p, i), sort).alias("link"))
        link = lambda p, i: F.when(i > 0, F.concat(F.right(F.get(x["spans"], i - 1)["match"], F.lit(1)), F.get(x["gaps"], i), F.left(p["match"], F.lit(1)))).otherwise(F.left(p["match"], F.lit(1)))
        return F.transform(x["spans"], part)

    both = F.struct(_spans(run["match"], PART, 3).alias("spans"), F.split(run["match"], PART, -1).alias("gaps"))
    parts = F.get(F.transform(F.array(both), scored), F.lit(0))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    first = F.struct(F.lit(0).alias("begin"), F.lit(0).alias("stop"), F.lit(-1.0).alias("sum"), F.lit(-1.0).alias("peak"), none.alias("out"))

    def closed(s: Column) -> Column:
        found = F.array(F.struct(s["begin"].alias("start"), s["stop"].alias("end")))
        return F.when((s["peak"] >= 0) & (s["stop"] - s["begin"] >= RUN_CHARS), F.concat(s["out"], found)).otherwise(s["out"])

    def step(s: Column, p: Column) -> Column:
        carried = F.when(s["sum"] < 0, F.lit(-1.0)).otherwise(s["sum"] + p["link"])
        joined = F.struct(carried.alias("carried"), (carried + p["own"]).alias("sum"))

        def after(j: Column) -> Column:
            long = (p["own"] >= 0) & (p["end"] - p["start"] >= RUN_CHARS) & (j["sum"] < s["peak"])
            fresh = (j["carried"] < 0) | (j["sum"] < s["peak"] - DROP) | long
            new = F.struct(p["start"].alias("begin"), p["end"].alias("stop"), p["own"].alias("sum"), p["own"].alias("peak"), closed(s).alias("out"))
            best = j["sum"] >= s["peak"]
            more = F.struct(s["begin"].alias("begin"), F.when(best, p["end"]).otherwise(s["stop"]).alias("stop"), j["sum"].alias("sum"), F.greatest(j["sum"], s["peak"]).alias("peak"), s["out"].alias("out"))
            return F.when(fresh, new).otherwise(more)

        return F.get(F.transform(F.array(joined), after), F.lit(0))

    found = F.aggregate(parts, first, step, closed)
    return F.transform(found, lambda x: F.struct((run["start"] + x["start"]).alias("start"), (run["start"] + x["end"]).alias("end"), F.lit(3).alias("kind"), F.substring(run["match"], x["start"] + 1, x["end"] - x["start"]).alias("match")))


def markov_spans(text: Column, ratios: Ratios, threshold: float = THRESHOLD) -> Column:
    random = lambda s: F.when(score(s["match"], ratios) >= threshold, F.array(s)).otherwise(_stretches(s, ratios, threshold))
    return F.when(text.rlike(RUN), F.flatten(F.transform(_spans(text, RUN, 3), random))).otherwise(_none())


def find_secrets(docs: DataFrame, text_col: str = "text", ratios: Ratios | None = None, threshold: float = THRESHOLD, into: str = "secrets") -> DataFrame:
    """Add the column ``into``: array of (start, end, kind), by start, then kind in the order of KINDS.

    Offsets are code points, the end exclusive. Runs are cut at the patterns' matches, and what is left of them is
    scored. Models are fitted on ``docs`` unless ``ratios`` is given: fitted models, which hold their thresholds, or
    one table of ratios, which ``threshold`` goes with.

    A null or empty text has no secrets. Repeated rows each get theirs. A column already named ``into`` is
    replaced; all others are kept as they are. No documents give no rows.
    """
    ratios = fit(docs, text_col) if ratios is None else ratios
    threshold = 0.0 if isinstance(ratios, Models) else threshold
    text = _text(text_col)
    base, rest, more = spare(docs, "_base"), spare(docs, "_rest"), spare(docs, "_more")
    work = docs.withColumn(base, base_spans(text)).withColumn(rest, masked(text, F.col(base))).withColumn(more, markov_spans(F.col(rest), ratios, threshold))
    plain = F.transform(F.concat(base, more), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return work.withColumn(into, F.transform(F.array_sort(plain), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).drop(base, rest, more)


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", placeholder: str = "[SECRET]", ratios: Ratios | None = None) -> DataFrame:
    """Replace every secret in the texts by ``placeholder``; all rows and columns stay.

    Overlapping spans are replaced together. A null text stays null. See find_secrets for the other cases.
    """
    secrets = spare(docs, "secrets")
    found = find_secrets(docs, text_col, ratios, into=secrets)
    text, columns = F.col(text_col), docs.columns
    changed = rebuilt(text, F.col(secrets), lambda n, apart: F.when(apart, F.lit(placeholder)).otherwise(""))
    return found.withColumn(text_col, changed).select(*[F.col(f"`{c}`") for c in columns])
