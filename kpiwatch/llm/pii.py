"""Personal data by base patterns and bootstrapped contextual extraction. DataFrame functions only.

Base spans are the leftmost non-overlapping matches of four patterns that pass their kind's check
(digit counts, Luhn, parts up to 255). They are the seeds of the bootstrap:

1. Every seed, and every other identifier-like run (SHORTEST characters or more with DIGITS digits, or an
   at sign; or digit groups joined by single spaces, dots, dashes and brackets, up to MOST digits), is an
   instance in a lexical context: the two words before it in the text, digits read as 0.
2. Instances and contexts form a graph whose edges are counted over all documents.
3. ROUNDS times: a pattern (context and kind) scores the share of its occurrences that the current
   confidences ascribe to the kind; an instance scores the noisy-or of its patterns. Seeds keep 1.
4. Patterns with a score of CONFIDENT or more and the weight of SUPPORT distinct instances are trusted. What
   stands in a trusted context is an added span of the pattern's kind, though no base pattern has it.

Offsets count code points; ends are exclusive. Spans come from the text's pieces between matches. Sums and
maxima of what comes before a span are kept for runs of RUN spans, and masked texts are put together from
chunks, so that a text with very many matches stays near linear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut

KINDS = ("email", "ip", "card", "phone")
SHORTEST = 5
DIGITS = 4
MOST = 19
RUN = 64
CHUNK = 4096
ROUNDS = 3
CONFIDENT = 0.8
SUPPORT = 3.0

# Possessive forms of the base patterns: they match the same spans, without backtracking or recursion.
# A match never starts inside a run that has failed from its first character on, so runs are tried once.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "other": r"(?<![0-9A-Za-z@._+-])(?:\(?+[0-9]++(?:\)?+[\x20.-]?+\(?+[0-9]++)++(?![0-9A-Za-z@_+])|(?=[A-Za-z._+-]*+[0-9@])[0-9A-Za-z@._+-]++)",
}
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "other": "[0-9@]"}
_SPAN = "array<struct<value: string, start: int, stop: int, left: string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, 1).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(False))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "other":
        long = F.length(value) >= SHORTEST
        grouped = F.rlike(value, F.lit(r"[\x20()]"))
        return long & ((F.length(digits) >= DIGITS) | value.contains("@")) & (~grouped | (F.length(digits) <= MOST))
    return F.lit(True)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with `value` evaluated once, also where `use` mentions it for each element of an array."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def _before(values: Column, total: Callable[[Column], Column], use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """use(f), where f(i) is the `total` (a sum or maximum, 0 for none) of the first i of `values`."""
    n = F.greatest(F.ceil(F.size(values) / RUN).cast("int"), F.lit(1))
    of_runs = F.transform(F.sequence(F.lit(0), n - 1), lambda r: total(F.slice(values, r * RUN + 1, F.lit(RUN))))
    of_starts = lambda runs: F.transform(F.sequence(F.lit(0), n), lambda r: total(F.slice(runs, F.lit(1), r)))

    def at(starts: Column) -> Callable[[Column], Column]:
        def f(i: Column) -> Column:
            run = F.floor(i / RUN).cast("int")
            return total(F.array(F.get(starts, run), total(F.slice(values, run * RUN + 1, i % RUN))))

        return f

    return _let(of_runs, lambda runs: _let(of_starts(runs), lambda starts: use(at(starts))))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _max(a: Column) -> Column:
    return F.coalesce(F.array_max(a), F.lit(0))


def _context(before: Column) -> Column:
    """The last two words of `before`, without case, digits as 0; null where there are fewer. Very long ones by their hash."""
    # Read backwards, the words are found at once, however long the text before them is.
    word, gap = r"[\p{L}\p{N}]++", r"[^\p{L}\p{N}]"
    last = F.reverse(F.regexp_extract(F.reverse(before), rf"^{gap}*+({word}{gap}++{word})", 1))
    plain = F.regexp_replace(F.regexp_replace(F.lower(last), rf"{gap}+", " "), "[0-9]+", "0")
    return F.when(last != "", F.when(F.length(plain) > 128, F.sha2(plain, 256)).otherwise(plain))


def _spans(text: Column, kind: str) -> Column:
    """The kind's valid spans in `text`, each with the context before it."""
    none = F.array().cast(_SPAN)

    def of(m: Column, p: Column, steps: Column) -> Column:
        def span(ends: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
            def one(x: Column, i: Column) -> Column:
                stop = ends(i + 1)
                # Two matches back there are two words, if there are any.
                near = [F.get(a, i - back) for back in (2, 1) for a in (p, m)]
                left = _context(F.concat_ws("", *near, F.get(p, i)))
                return F.struct(x.alias("value"), (stop - F.char_length(x)).alias("start"), stop.alias("stop"), left.alias("left"))

            return one

        good = F.transform(m, lambda x, i: F.struct(x.alias("x"), i.alias("i"), _valid(kind, x).alias("ok")))
        return _before(steps, _sum, lambda ends: F.transform(F.filter(good, lambda g: g["ok"]), lambda g: span(ends)(g["x"], g["i"])))

    def pieces(m: Column) -> Column:
        steps = lambda p: F.transform(m, lambda x, i: F.char_length(x) + F.char_length(F.get(p, i)))
        return _let(F.split(text, _PATTERNS[kind], -1), lambda p: _let(steps(p), lambda s: of(m, p, s)))

    matches = F.regexp_extract_all(text, F.lit(_PATTERNS[kind]), F.lit(0))
    hit = F.rlike(text, F.lit(_HINTS[kind]))
    return F.when(hit, _let(matches, lambda m: F.when(F.size(m) > 0, pieces(m)).otherwise(none))).otherwise(none)


def _clear(base: Column, other: Column) -> Column:
    """The spans of `other` (which don't overlap each other) that overlap none of `base`."""
    marked = lambda a, is_other: F.transform(a, lambda s: F.struct(s["start"].alias("start"), F.lit(is_other).alias("other"), s["stop"].alias("stop"), s.alias("s")))

    def of(spans: Column) -> Column:
        def free(ends: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
            def one(s: Column, i: Column) -> Column:
                # After a span of `other`, only what starts before the next such span can overlap it.
                after = F.get(spans, i + 1)
                met = F.coalesce(~after["other"] & (after["start"] < s["stop"]), F.lit(False))
                return F.when(s["other"], (ends(i) <= s["start"]) & ~met).otherwise(False)

            return one

        stops = F.transform(spans, lambda s: F.when(s["other"], 0).otherwise(s["stop"]))
        return _let(stops, lambda v: _before(v, _max, lambda ends: F.transform(F.filter(spans, free(ends)), lambda s: s["s"])))

    both = F.sort_array(F.concat(marked(base, False), marked(other, True)))
    return F.when((F.size(base) == 0) | (F.size(other) == 0), other).otherwise(_let(both, of))


def found(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), the four kinds' base spans and `other`: identifier-like runs beside them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("th", F.xxhash64("text"))
    rows = rows.select("doc_id", "th", *(_spans(F.col("text"), k).alias(k) for k in (*KINDS, "other")))
    clear = _let(F.concat(*(F.col(k) for k in KINDS)), lambda base: _clear(base, F.col("other")))
    return rows.withColumn("other", clear)


def _instances(spans: DataFrame) -> DataFrame:
    """doc_id, th, kind (null for an identifier of no kind), start, stop, node (hash of the value), left."""

    def tagged(k: str) -> Column:
        kind = F.lit(k if k in KINDS else None).cast("string").alias("kind")
        return F.transform(k, lambda s: F.struct(kind, s["start"].alias("start"), s["stop"].alias("stop"), F.xxhash64(F.lower(s["value"])).alias("node"), s["left"].alias("left")))

    all_tagged = F.concat(*(tagged(k) for k in (*KINDS, "other")))
    return spans.select("doc_id", "th", F.explode(all_tagged).alias("i")).select("doc_id", "th", "i.*").filter("left IS NOT NULL")


def patterns(instances: DataFrame) -> DataFrame:
    """left, kind, score, weight: the trusted patterns; at most one kind for a context."""
    edges = cut(instances.groupBy("left", "node", "kind").agg(F.count("*").alias("times")))
    seeds = edges.filter("kind IS NOT NULL").select("node", "kind").distinct().withColumn("conf", F.lit(1.0))
    of_context = edges.groupBy("left").agg(F.sum("times").alias("all_times"))
    links = edges.groupBy("left", "node").agg(F.sum("times").alias("times"))
    beliefs = seeds
    for _ in range(ROUNDS):
        held = links.join(beliefs, "node").groupBy("left", "kind").agg(F.sum(F.col("times") * F.col("conf")).alias("mass"), F.sum("conf").alias("weight"))
        scored = held.join(of_context, "left").select("left", "kind", (F.col("mass") / (F.col("all_times") + 1)).alias("score"), "weight")
        scored = cut(scored)
        trusted = scored.filter(F.col("weight") >= SUPPORT)
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        learned = links.join(trusted, "left").groupBy("node", "kind").agg((1 - doubt).alias("conf"))
        beliefs = learned.join(seeds.select("node"), "node", "left_anti").unionByName(seeds)
    good = scored.filter((F.col("score") >= CONFIDENT) & (F.col("weight") >= SUPPORT))
    best = F.max(F.struct("score", "weight", "kind")).alias("best")
    return good.groupBy("left").agg(best).select("left", "best.*")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, th, n_email, n_ip, n_card, n_phone, base_sha256, spans, all_spans: one row per row of `docs`.

    n_* and base_sha256 tell the base spans; spans (text) and all_spans (array of kind, start, stop,
    sorted by kind as in KINDS, then start) have the added ones too. Null texts are empty. Rows that
    repeat a doc_id and text give equal rows, as many as there are. An empty table gives an empty result.
    """
    spans = cut(found(docs))
    instances = _instances(spans)
    added = instances.filter("kind IS NULL").drop("kind").join(patterns(instances), "left")
    more = added.groupBy("doc_id", "th").agg(F.collect_set(F.struct("kind", "start", "stop")).alias("more"))
    more = more.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "more")
    rows = spans.join(more, spans["doc_id"].eqNullSafe(more["__id"]) & (spans["th"] == more["__th"]), "left")
    plain = lambda k: F.transform(k, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    one = lambda k: F.filter("more", lambda s: s["kind"] == k)
    none = F.array().cast("array<struct<kind: string, start: int, stop: int>>")
    every = F.concat(*(F.sort_array(F.concat(plain(k), F.coalesce(one(k), none))) for k in KINDS))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return rows.select(
        "doc_id",
        "th",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(said(F.concat(*(plain(k) for k in KINDS))), 256).alias("base_sha256"),
        said(every).alias("spans"),
        every.alias("all_spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """`text` with every span replaced by its kind in brackets; of overlapping ones, the earlier stands."""
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))

    def of(chunks: Column, spans: Column, stops: Column) -> Column:
        def part(a: Column, z: Column) -> Column:
            first, last = F.floor(a / CHUNK).cast("int"), F.floor(F.greatest(z - 1, a) / CHUNK).cast("int")
            return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), a - first * CHUNK + 1, z - a)

        def one(ends: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
            tag = lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return lambda s, i: _let(ends(i), lambda at: F.when(s["start"] >= at, F.concat(part(at, s["start"]), tag(s))).otherwise(""))

        body = _before(stops, _max, lambda ends: F.array_join(F.transform(spans, one(ends)), ""))
        return F.concat(body, part(_max(stops), F.char_length(text)))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    stops = lambda s: F.transform(s, lambda x: x["stop"])
    return _let(chunks, lambda c: _let(by_start, lambda s: _let(stops(s), lambda v: of(c, s, v))))


def masked(docs: DataFrame) -> DataFrame:
    """`docs` with all spans of `text` masked, all columns kept; n_chars, where there is one, follows the text."""
    spans = personal_data(docs).filter("size(all_spans) > 0")
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("all_spans").alias("__spans")).dropDuplicates(["__id", "__th"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({"__key": F.col("doc_id").cast("long"), "__text": F.xxhash64(text)})
    both = keyed.join(spans, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__th")), "left")
    new = both.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(_masked(F.col("text"), F.col("__spans"))))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)
