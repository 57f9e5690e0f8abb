"""Secret scan: pattern matches plus strings that look random to two Markov models.

Base kinds are found by patterns.  Beyond them, every token of any length is
scored by the log-likelihood ratio of two character models, one of random
strings and one of ordinary tokens, trained from labelled samples; tokens that
reach a threshold are added as spans of kind ``markov``, and of other tokens
the stretches of whole pieces (between ``/ = + _ -``) that reach it, so that an
ordinary path or name around a random string does not hide it.

Everything is DataFrame work on built-in functions.  The regex functions give
matches without positions, so a text is also split at its matches: lengths of
the pieces and of the matches add up to start and end, in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in listed order: pattern, group that holds the value.
#: A run of 24+ hex digits, or of 20+ characters from AKIA on, is matched in
#: full or not at all, so the minimum can stand in the pattern; the minimum of
#: an assignment can't, since a failing match still uses up its text.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN = 6

#: Tokens that the models score, and the parts of one: a piece and what parts
#: it from the next.
TOKEN = r"[A-Za-z0-9+/_=-]+"
PART = r"[A-Za-z0-9]+[+/_=-]*|[+/_=-]+"
PIECE = r"^[A-Za-z0-9]*"
#: Characters that the models tell apart; all others are one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
#: Least total log-likelihood ratio (nats): odds that outweigh a prior of one
#: random string in about three thousand tokens.
THRESHOLD = 8.0
#: Weight of single characters where a transition is rare.
BACKOFF = 10.0

#: Tokens of a text that are looked up in a list.
LISTED = 32

_CHUNK = 128


def _fold(parts: Column, start: Column) -> Column:
    """Spans of ``parts`` (gap, length, kind, value), laid out from ``start``."""
    span = "start int, end int, kind int, value string"
    first = F.struct(start.cast("int").alias("at"),
                     F.array().cast(f"array<struct<{span}>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        one = F.struct(begin.alias("start"), (begin + x["length"]).alias("end"),
                       x["kind"].alias("kind"), x["value"].alias("value"))
        return F.struct((begin + x["length"]).alias("at"),
                        F.concat(acc["spans"], F.array(one)).alias("spans"))

    return F.aggregate(parts, first, step, lambda acc: acc["spans"])


def _located(parts: Column) -> Column:
    """As :func:`_fold` for any number of parts: positions of chunks first,
    then inside each chunk, so work stays close to linear."""
    chunks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _CHUNK).cast("int"))

    def chunk(c: Column) -> Column:
        return F.slice(parts, c * _CHUNK + 1, F.lit(_CHUNK))

    def length(c: Column) -> Column:
        return F.aggregate(chunk(c), F.lit(0), lambda a, x: a + x["gap"] + x["length"])

    starts = F.aggregate(
        chunks, F.array(F.lit(0)),
        lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + length(c))))
    return F.flatten(F.transform(chunks, lambda c: _fold(chunk(c), F.get(starts, c))))


def _with_kind(docs: DataFrame, name: str, pattern: str, kind: int,
               where: Column | None = None) -> DataFrame:
    """Adds ``name``: the pattern's matches with their places, in the texts
    ``where`` names; texts without a match cost one pass of the pattern."""
    text = F.coalesce("text" if where is None else F.when(where, F.col("text")), F.lit(""))
    found = f"{name}_found"
    docs = docs.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    parts = f"{name}_parts"
    docs = docs.withColumn(parts, F.when(
        F.size(found) > 0,
        F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                   lambda g, v: F.struct(g.alias("gap"), F.char_length(v).alias("length"),
                                         F.lit(kind).alias("kind"), v.alias("value")))))
    spans = F.when(F.size(found) > 0, _located(F.col(parts))).otherwise(
        F.array().cast("array<struct<start int, end int, kind int, value string>>"))
    return docs.withColumn(name, spans).drop(found, parts)


def with_matches(docs: DataFrame) -> DataFrame:
    """Adds ``__base``, the base spans by start."""
    for name, pattern, kind in (("__assign", ASSIGN, 0), ("__access", ACCESS, 1), ("__hex", HEX, 2)):
        docs = _with_kind(docs, name, pattern, kind)
    value = F.transform("__assign", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        F.regexp_extract(s["value"], ASSIGN, 2).alias("value")))
    long_enough = F.filter(value, lambda s: F.char_length(s["value"]) >= MIN_ASSIGN)
    docs = docs.withColumn("__base", _by_place(F.concat(long_enough, F.col("__access"), F.col("__hex"))))
    return docs.drop("__assign", "__access", "__hex")


def _by_place(spans: Column) -> Column:
    """Sorted by start, then kind as listed."""
    key = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        s["value"].alias("value")))
    return F.transform(F.array_sort(key), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["value"].alias("value")))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition, from labelled ``(value, label)``
    rows, or ``(value, label, n)`` with the weight of each: label 1 random, 0
    ordinary.  Transitions are counted with Spark; only the counts, at most
    twice the squared alphabet, reach the driver.

    ``P(b|a) = (n(ab) + BACKOFF * P(b)) / (n(a) + BACKOFF)`` and ``P(b) =
    (n(b) + 1) / (N + size of the alphabet)``: after a character that a class
    never showed, the class still knows which characters are rare.  An empty
    class is a uniform model.  Null values or labels are ignored."""
    weight = F.col("n") if "n" in samples.columns else F.lit(1)
    pairs = samples.where("value is not null and label is not null and char_length(value) >= 2").select(
        "label", weight.alias("n"), F.explode(F.transform(
            F.sequence(F.lit(1), F.char_length("value") - 1),
            lambda i: _code(F.substring("value", i, F.lit(1))) * _SIDE
            + _code(F.substring("value", i + 1, F.lit(1))))).alias("pair"))
    counts = {0: [0] * _SIDE ** 2, 1: [0] * _SIDE ** 2}
    for r in pairs.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        if r["label"] in counts:
            counts[r["label"]][r["pair"]] = r["n"]
    logs = {}
    for label, n in counts.items():
        after = [sum(n[b::_SIDE]) for b in range(_SIDE)]
        single = [(x + 1) / (sum(after) + _SIDE) for x in after]
        logs[label] = []
        for a in range(_SIDE):
            row = n[a * _SIDE:(a + 1) * _SIDE]
            logs[label] += [math.log((x + BACKOFF * p) / (sum(row) + BACKOFF))
                            for x, p in zip(row, single)]
    return [x - y for x, y in zip(logs[1], logs[0])]


_SIDE = len(ALPHABET) + 1


def _code(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def _summed(value: Column, ratio: list[float], **sums) -> Column:
    """One pass over a string's transitions; each of ``sums`` gives its next
    value from all values so far and a transition's ratio."""
    model = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    places = F.split(F.lit(",".join(str(ALPHABET.find(chr(i)) + 1) for i in range(128))), ",").cast("array<int>")
    # of what stands before the first character there is no transition
    first = F.struct(F.lit(-1).alias("before"), *[F.lit(0.0).alias(name) for name in sums])

    def step(acc: Column, char: Column) -> Column:
        code = F.coalesce(F.get(places, F.ascii(char)), F.lit(0))
        x = F.coalesce(F.get(model, acc["before"] * _SIDE + code), F.lit(0.0))
        return F.struct(code.alias("before"), *[f(acc, x).alias(name) for name, f in sums.items()])

    return F.aggregate(F.split(value, ""), first, step)


def log_ratio(value: Column, ratio: list[float]) -> Column:
    """Total log-likelihood ratio of a string: random against ordinary."""
    return _summed(value, ratio, total=lambda acc, x: acc["total"] + x)["total"]


def _best_stretch(value: Column, ratio: list[float]) -> Column:
    """The most that any stretch of a string's transitions adds up to."""
    def upto(acc: Column, x: Column) -> Column:
        return F.greatest(acc["open"], F.lit(0.0)) + x

    return _summed(value, ratio, open=upto, best=lambda acc, x: F.greatest(acc["best"], upto(acc, x)))["best"]


def own_samples(docs: DataFrame) -> DataFrame:
    """Labelled samples ``(value, label, n)`` from a corpus itself, all of it:
    the distinct values of base spans are random strings, once each; the
    distinct other tokens are ordinary, with the number of texts that hold
    them.  One pass over the texts; tokens are counted where they are read,
    before they are shuffled."""
    # only a text with a base span has anything to take out
    rest = F.when(F.size("__base") > 0, F.regexp_replace("text", ASSIGN, " ")).otherwise(F.col("text"))
    tokens = F.array_distinct(F.regexp_extract_all(F.coalesce(rest, F.lit("")), F.lit(TOKEN), F.lit(0)))

    def labelled(values: Column, label: int) -> Column:
        return F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(label).alias("label")))

    values = F.transform("__base", lambda b: b["value"])
    found = (with_matches(docs.select("text"))
             .select(F.explode(F.concat(labelled(values, 1), labelled(tokens, 0))).alias("s"))
             .groupBy("s.value", "s.label").agg(F.count(F.lit(1)).alias("n")))
    return (found.where((F.col("label") == 1) | ~F.col("value").rlike(f"{HEX}|{ACCESS}"))
            .withColumn("n", F.when(F.col("label") == 1, F.lit(1).cast("long")).otherwise(F.col("n"))))


def _touches(start: Column, end: Column) -> Column:
    """Whether a base span overlaps the place.  Spans of one kind lie apart, so
    the first that ends behind ``start`` is found by halving."""
    def of_kind(spans: Column) -> Column:
        steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
        span = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

        def halve(acc: Column, _: Column) -> Column:
            mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
            left = (acc["low"] < acc["high"]) & (F.get(spans, mid)["end"] > start)
            right = (acc["low"] < acc["high"]) & ~left
            return F.struct(F.when(right, mid + 1).otherwise(acc["low"]).alias("low"),
                            F.when(left, mid).otherwise(acc["high"]).alias("high"))

        first = F.aggregate(steps, span, halve, lambda acc: acc["low"])
        return F.coalesce(F.get(spans, first)["start"] < end, F.lit(False))

    return F.exists("__by_kind", of_kind)


def _random_spans(run: Column, ratio: list[float], threshold: float) -> Column:
    """Spans of a token: itself if it reaches ``threshold`` and touches no base
    span, else its stretches of whole pieces that do.

    A stretch starts anew where its sum falls below zero, and ends at its
    highest sum once that is reached and lost again by as much as
    ``threshold``, so a second random string gets a span of its own."""
    def span(start: Column, end: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(3).alias("kind"),
                        F.substring(run["value"], start - run["start"] + 1, end - start).alias("value"))

    texts = F.regexp_extract_all(run["value"], F.lit(PART), F.lit(0))
    after = F.concat(F.transform(F.slice(texts, F.lit(2), F.size(texts)), lambda x: F.substring(x, 1, 1)),
                     F.array(F.lit("")))
    parts = F.zip_with(texts, after, lambda x, y: F.struct(
        F.char_length(F.regexp_extract(x, PIECE, 0)).alias("piece"), F.char_length(x).alias("length"),
        log_ratio(F.regexp_extract(x, PIECE, 0), ratio).alias("inner"),
        log_ratio(F.concat(x, y), ratio).alias("upto_next")))
    none = F.array().cast("array<struct<start int, end int, kind int, value string>>")
    first = F.struct(run["start"].cast("int").alias("at"), F.lit(False).alias("open"), F.lit(0).alias("start"),
                     F.lit(0).alias("end"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("high"), none.alias("spans"))

    def closed(acc: Column) -> Column:
        found = acc["open"] & (acc["high"] >= threshold)
        return F.when(found, F.concat(acc["spans"], F.array(span(acc["start"], acc["end"])))).otherwise(acc["spans"])

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + x["piece"]
        barred = (x["piece"] == 0) | _touches(acc["at"], end)
        upto = acc["sum"] + x["inner"]
        anew = barred | ~acc["open"] | (acc["sum"] < 0) | (
            (acc["high"] >= threshold) & (acc["high"] - upto >= threshold))
        higher = anew | (upto > acc["high"])
        total = F.when(anew, x["inner"]).otherwise(upto)
        return F.struct(
            (acc["at"] + x["length"]).alias("at"), (~barred).alias("open"),
            F.when(anew, acc["at"]).otherwise(acc["start"]).alias("start"),
            F.when(higher, end).otherwise(acc["end"]).alias("end"),
            (total + x["upto_next"] - x["inner"]).alias("sum"),
            F.when(higher, total).otherwise(acc["high"]).alias("high"),
            F.when(anew, closed(acc)).otherwise(acc["spans"]).alias("spans"))

    whole = ~_touches(run["start"], run["end"]) & (log_ratio(run["value"], ratio) >= threshold)
    return F.when(whole, F.array(span(run["start"], run["end"]))).otherwise(F.filter(
        F.aggregate(parts, first, step, closed), lambda s: s["value"].rlike("[A-Za-z]")))


def with_spans(matches: DataFrame, ratio: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``__spans``: base spans and those that the models find, by place.

    Each distinct token of a text that holds a letter is scored once (plain
    numbers and rules of dashes are no secrets); places are worked out only in
    texts with a token that may hold a span."""
    # no shorter token can reach the threshold
    most = max(ratio)
    least = 2 + max(0, math.ceil(threshold / most) - 1) if most > 0 else 2
    def may_be(v: Column) -> Column:
        return (F.char_length(v) >= least) & v.rlike("[A-Za-z]")

    def holds(v: Column) -> Column:
        return F.when(v.rlike("[+/_=-]"), _best_stretch(v, ratio)).otherwise(log_ratio(v, ratio)) >= threshold

    tokens = F.filter(F.array_distinct(F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(TOKEN), F.lit(0))), may_be)
    found = matches.withColumn("__hot", F.filter(tokens, holds))
    found = _with_kind(found, "__runs", TOKEN, 3, F.size("__hot") > 0)

    def of_kind(kind: int) -> Column:
        return F.filter("__base", lambda b: b["kind"] == kind)

    found = found.withColumn("__by_kind", F.filter(F.array(*map(of_kind, range(3))), lambda x: F.size(x) > 0))
    # a long list is not searched for each token: the token is scored again
    hot = F.filter("__runs", lambda r: F.when(F.size("__hot") <= LISTED, F.array_contains("__hot", r["value"]))
                   .otherwise(may_be(r["value"]) & holds(r["value"])))
    random = F.flatten(F.transform(hot, lambda r: _random_spans(r, ratio, threshold)))
    return found.withColumn("__spans", _by_place(F.concat("__base", random))).drop("__hot", "__runs", "__by_kind")


def _text_of(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, samples: DataFrame | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans)``, a
    row per row of ``docs``.

    Whole texts are scanned; a null text is empty and gives no spans; repeated
    rows each get their row; an empty table gives an empty result; other
    columns are ignored.  ``samples``: labelled ``(value, label)`` rows, by
    default those of :func:`own_samples`.
    """
    own = docs.select("doc_id", "text")
    matches = with_matches(own)
    ratio = train(own_samples(own) if samples is None else samples)

    def count(kind: int) -> Column:
        return F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")

    return with_spans(matches, ratio, threshold).select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_text_of(F.col("__base")), 256).alias("base_sha256"),
        _text_of(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", samples: DataFrame | None = None,
           threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that overlap become
    one mark.  ``n_chars``, where there is one, follows the new text.  Texts
    without a span, null ones included, and all other columns, whatever their
    names, stay as they are; repeated rows stay repeated, an empty table stays
    empty."""
    cols = docs.columns
    if samples is None:
        samples = own_samples(docs)
    # the rows' own columns travel in one, where no name can clash
    found = with_spans(with_matches(docs.select("text", F.struct("*").alias("__row"))),
                       train(samples), threshold)
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        more = F.concat(acc["parts"], F.array(
            F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(apart, more).otherwise(acc["parts"]).alias("parts"))

    whole = F.aggregate("__spans", first, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""),
        F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))))
    hit = F.size("__spans") > 0
    out = found.select("__row", hit.alias("__hit"), F.when(hit, whole).otherwise(F.col("text")).alias("__new"))
    row = F.col("__row")
    said = {"text": F.col("__new")}
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        said["n_chars"] = F.when(F.col("__hit"), F.char_length("__new")).otherwise(row["n_chars"]).cast(kind)
    return out.select(*[said.get(c, row.getField(c)).alias(c) for c in cols])
