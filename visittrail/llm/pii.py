"""Personal data: fixed patterns, and bootstrapped contexts that find identifiers they miss.

Spans that fixed patterns find are the seeds. Words before and after a seed, both together, and a word
before with the seed's shape are lexical patterns of several families; whatever stands in the same place
elsewhere are a pattern's instances. Patterns and instances form a graph that is scored in turns,
until nothing changes: a pattern by the score of its instances, an instance by the best patterns
of the families it occurs with. Words that are trusted themselves become spans where a trusted pattern
introduces them. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visittrail.llm.common import prepare, stored, with_row_number

KINDS = ("email", "ip", "card", "phone")

#: While cards are sought, a space or hyphen between digits is written as this letter of the private
#: area, and while e-mail addresses are sought, a full stop between letters of a domain. What is
#: joined that way is then a run of one class of letters; a loop over groups could not take a
#: text that is one long number or domain. A text's own such letters become others meanwhile.
_JOINT, _OTHER = "\ue000", "\ue001"

#: A start is refused after a letter of its class, as an earlier start would have been taken,
#: unless a match has just ended there (\\G).
_EMAIL = (rf"(?:\G|(?<![A-Za-z0-9._%+{_JOINT}-]))[A-Za-z0-9._%+{_JOINT}-]++@"
          rf"[A-Za-z0-9-]++{_JOINT}[A-Za-z0-9{_JOINT}-]*+")
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = f"[0-9][0-9{_JOINT}]++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: An identifier-like word: a word with a digit or an @, up to the next white space.
_WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

#: Signs that a word's end is stripped of; a longer word stands for itself by its digest.
_TAIL, LONG = ".,;:!?)]}\"'>", 64
#: Contexts are up to this many words before a word, within so many letters.
CONTEXT_WORDS, CONTEXT_LETTERS = 3, 64
#: A pattern needs so many different seeds; patterns and instances are trusted from this score on.
#: Scores settle in a few rounds; so many are made at most.
LEAST_SEEDS, TRUST, ROUNDS = 5, 0.9, 20

_HITS = "array<struct<gap:int,match:string,before:string,after:string>>"


def _matches(text: Column, pattern: str, when: Column, with_after: bool = False) -> Column:
    """Each match with the text since the one before it, and some of what comes after."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def ended(gap: Column) -> Column:
        return F.substring(gap, -CONTEXT_LETTERS, CONTEXT_LETTERS)

    found = F.zip_with(gaps, matches, lambda gap, match: F.struct(
        F.length(gap).alias("gap"), match.alias("match"), ended(gap).alias("before")))
    following = F.slice(gaps, 2, 1 << 30) if with_after else F.array().cast("array<string>")
    found = F.zip_with(found, following, lambda x, gap: F.struct(
        x["gap"].alias("gap"), x["match"].alias("match"), x["before"].alias("before"),
        F.substring(gap, 1, CONTEXT_LETTERS).alias("after")))
    none = F.array().cast(_HITS)
    return F.when(when, F.filter(found, lambda x: x["match"].isNotNull())).otherwise(none)


def _joined(text: Column, left: str, joint: str, right: str) -> Column:
    plain = F.translate(text, _JOINT, _OTHER)
    return F.regexp_replace(plain, f"(?<={left}){joint}(?={right})", _JOINT)


def found_by_pattern(text: Column) -> dict[str, Column]:
    """For each kind, and for identifier-like words, the matches in a text."""
    digit = text.rlike("[0-9]")
    return {
        "email": _matches(_joined(text, "[A-Za-z0-9-]", r"\.", "[A-Za-z0-9-]"), _EMAIL,
                          text.contains("@")),
        "ip": _matches(text, _IP, digit & text.rlike(r"[0-9]\.[0-9]")),
        "card": _matches(_joined(text, "[0-9]", "[ -]", "[0-9]"), _CARD, digit),
        "phone": _matches(text, _PHONE, text.contains("+")),
        "word": _matches(text, _WORD, digit | text.contains("@"), with_after=True),
    }


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), size), F.lit(0),
        lambda total, i: total + _luhn_digit(
            F.substring(digits, i, F.lit(1)).cast("int"), (size - i) % 2 == 1))
    return total % 10 == 0


def _luhn_digit(d: Column, doubled: Column) -> Column:
    return F.when(doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    parts_ok = F.forall(F.split(value, r"\."), lambda x: x.rlike(
        "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"))
    return (
        F.when(kind == "ip", parts_ok)
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def _placed(hits: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, before, after): matches with their places in the text."""
    before = Window.partitionBy("row", "kind").orderBy("i")
    length = F.length("match")
    end = F.sum(F.col("gap") + length).over(before).cast("long")
    return hits.select(
        "row", "kind", "i", (end - length).cast("long").alias("start"), end.alias("end"),
        F.col("match").alias("value"), "before", "after")


def _words(text: Column) -> Column:
    """Words in small letters, numbers as 0."""
    plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    return F.filter(F.split(plain, r"\s+"), lambda w: w != "")


def _shape(value: Column) -> Column:
    """Digits as 9, runs of small and of capital letters as a and A."""
    digits = F.regexp_replace(value, "[0-9]", "9")
    return F.regexp_replace(F.regexp_replace(digits, "[a-z]+", "a"), "[A-Z]+", "A")


def _patterns(before: Column, after: Column, value: Column) -> Column:
    """The patterns a word stands in, the family in front: words before it, the word after it,
    both, and the word before it with its own shape. What a place lacks gives no pattern."""
    left, right = _words(before), F.get(_words(after), F.lit(0))
    last = F.get(left, F.size(left) - 1)
    some = [
        F.when(F.size(left) >= n, F.concat(F.lit(f"l{n} "), F.array_join(
            F.slice(left, -F.least(F.size(left), F.lit(n)), n), " ")))
        for n in range(1, CONTEXT_WORDS + 1)
    ]
    some += [F.concat(F.lit("r "), right), F.concat(F.lit("lr "), last, F.lit(" "), right),
             F.concat(F.lit("ls "), last, F.lit(" "), F.left(_shape(value), F.lit(LONG)))]
    return F.array_compact(F.array(*some))


def _of_kind(kind: str, found: Column) -> Column:
    return F.transform(found, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"),
        x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after")))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, doc_id, hits): one pass over the whole texts, stored without them."""
    found = found_by_pattern(F.coalesce(F.col(text), F.lit("")))
    hits = F.concat(*(_of_kind(kind, own) for kind, own in found.items()))
    rows = docs.select(F.col(doc_id).alias("doc_id"), hits.alias("hits"))
    return stored(with_row_number(rows, "row"), "pii-hits")


def spans_and_words(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base spans (row, kind, start, end, value), and words (row, start, end, value, patterns,
    seed): seed is the kind of the base span that begins in the word, null if none does; such a
    word's value is the span's. A long value is given by its digest.

    Words that lie within a span but begin none are left out.
    """
    placed = _placed(scanned.select("row", F.inline("hits")))
    base = placed.filter((F.col("kind") != "word") & _valid(F.col("kind"), F.col("value")))
    base = base.select("row", "kind", "start", "end", "value")

    words = placed.filter("kind = 'word'").select(
        "row", "start", F.rtrim("value", F.lit(_TAIL)).alias("value"), "before", "after")
    words = words.withColumn("end", F.col("start") + F.length("value"))
    # A span begins in the last word that begins at or before it.
    no_text = F.lit(None).cast("string")
    events = words.select(
        "row", "start", "end", no_text.alias("kind"), "value", "before", "after",
    ).unionByName(base.select(
        "row", "start", "end", "kind", "value", no_text.alias("before"), no_text.alias("after")))
    order = Window.partitionBy("row").orderBy("start", F.col("kind").isNotNull())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, 1)
    seen = events.withColumn(
        "covered", F.max(F.when(F.col("kind").isNotNull(), F.col("end"))).over(earlier)
    ).withColumns({f"next_{c}": F.first(c).over(later) for c in ("kind", "start", "end", "value")})
    inside = F.coalesce(F.col("covered") > F.col("start"), F.lit(False))
    seed = F.when(F.col("next_kind").isNotNull() & (F.col("next_start") < F.col("end")),
                  F.col("next_kind"))
    kept = seen.filter(F.col("kind").isNull() & ~inside)
    value = F.when(seed.isNotNull(), F.col("next_value")).otherwise(F.col("value"))
    # What follows a seed of several words is not what follows the first of them.
    after = F.when(seed.isNull() | (F.col("next_end") <= F.col("end")), F.col("after"))
    short = F.when(F.length(value) > LONG, F.sha2(value, 256)).otherwise(value)
    return base, kept.select(
        "row", "start", "end", short.alias("value"),
        _patterns(F.col("before"), after, value).alias("patterns"), seed.alias("seed"))


def trusted(words: DataFrame, rounds: int = ROUNDS, trust: float = TRUST,
            least_seeds: int = LEAST_SEEDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, score) of trusted patterns and (value, kind, score) of trusted instances.

    A pattern's score is the mean score of the words it stands around, each different word
    once: 1 for a seed of the kind, 0 for a seed of another kind, otherwise the word's own score
    for the kind, 0 at first. A word's score is 1 - product of (1 - score) over the families of
    patterns, each with the best trusted pattern the word occurs with. Rounds end when no score
    changes. All are sums and maxima, so neither a frequent pattern nor a frequent word is ever
    gathered. Edges are stored; scores are checkpointed after each round.
    """
    edges = stored(
        words.filter(F.col("value") != "").select(
            F.explode("patterns").alias("pattern"), "value", "seed")
        .groupBy("pattern", "value").agg(
            *(F.max(F.when(F.col("seed") == k, 1).otherwise(0)).alias(f"seed_{k}")
              for k in KINDS)), "pii-edges")
    any_seed = sum((F.col(f"seed_{k}") for k in KINDS), F.lit(0)) > 0
    instances, before = None, None
    for _ in range(rounds):
        scored = edges
        if instances is not None:
            scored = edges.join(instances.withColumnRenamed("value", "of"),
                                F.col("value") == F.col("of"), "left").drop("of")
        score = {
            k: F.when(F.col(f"seed_{k}") == 1, 1.0).when(any_seed, 0.0).otherwise(
                F.coalesce(F.col(f"score_{k}"), F.lit(0.0)) if instances is not None
                else F.lit(0.0))
            for k in KINDS
        }
        patterns = scored.groupBy("pattern").agg(
            *(F.avg(score[k]).alias(f"p_{k}") for k in KINDS),
            *(F.sum(f"seed_{k}").alias(f"n_{k}") for k in KINDS))
        good = {k: (F.col(f"p_{k}") >= trust) & (F.col(f"n_{k}") >= least_seeds) for k in KINDS}
        anything = F.lit(False)
        for k in KINDS:
            anything = anything | good[k]
        patterns = patterns.filter(anything).select("pattern", *(
            F.when(good[k], F.col(f"p_{k}")).otherwise(0.0).alias(f"p_{k}") for k in KINDS))
        patterns = patterns.checkpoint()
        met = edges.filter(~any_seed).join(
            patterns.withColumnRenamed("pattern", "in"), F.col("pattern") == F.col("in"))
        best = met.groupBy("value", F.substring_index("pattern", " ", 1).alias("family")).agg(
            *(F.max(f"p_{k}").alias(f"p_{k}") for k in KINDS))
        doubt = {k: F.exp(F.sum(F.log(F.greatest(1 - F.col(f"p_{k}"), F.lit(1e-9)))))
                 for k in KINDS}
        instances = best.groupBy("value").agg(
            *((1 - doubt[k]).alias(f"score_{k}") for k in KINDS)).checkpoint()
        sums = [F.round(F.sum(f"{x}_{k}"), 6) for x in ("p",) for k in KINDS]
        now = (patterns.agg(F.count(F.lit(1)), *sums).first(), instances.agg(
            F.count(F.lit(1)), *(F.round(F.sum(f"score_{k}"), 6) for k in KINDS)).first())
        if now == before:
            break
        before = now

    def by_kind(rows: DataFrame, name: str, prefix: str) -> DataFrame:
        each = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"{prefix}_{k}").alias("score"))
                         for k in KINDS))
        return rows.select(name, F.inline(each)).filter(F.col("score") >= trust)

    return by_kind(patterns, "pattern", "p"), by_kind(instances, "value", "score")


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  **options) -> DataFrame:
    """(row, doc_id, base, added) of every row: spans as arrays of (start, kind, end).

    `added` are trusted words where they stand in a trusted pattern and begin no base span, with
    the kind of the word's highest score (the first in KINDS among equals). Base spans always stay. Null and
    empty texts have no spans; repeated rows each have theirs. Places count code points, ends are
    exclusive.
    """
    prepare(docs.sparkSession)
    scanned = scan(docs, text, doc_id)
    base, words = spans_and_words(scanned)
    words = stored(words, "pii-words")
    patterns, instances = trusted(words, **options)
    found = words.filter(F.col("seed").isNull() & (F.col("value") != "")).select(
        "row", "start", "end", "value", F.explode("patterns").alias("pattern"))
    found = found.join(patterns.select("pattern", "kind"), "pattern").select(
        "row", "start", "end", "value", "kind").distinct()
    new = found.join(instances, ["value", "kind"])
    rank = sum((F.when(F.col("kind") == k, i) .otherwise(0) for i, k in enumerate(KINDS)), F.lit(0))
    new = new.groupBy("row", "start", "end").agg(
        F.max_by("kind", F.struct("score", -rank)).alias("kind"))

    def gathered(rows: DataFrame, name: str) -> DataFrame:
        span = F.struct("start", rank.alias("rank"), "end", "kind")
        return rows.groupBy(F.col("row").alias(f"{name}_row")).agg(
            F.array_sort(F.collect_list(span)).alias(name))

    out = scanned.select("row", "doc_id")
    for rows, name in ((base, "base"), (new, "added")):
        out = out.join(gathered(rows, name), F.col("row") == F.col(f"{name}_row"), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return out.select("row", "doc_id", F.coalesce("base", none).alias("base"),
                      F.coalesce("added", none).alias("added"))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
