"""Secrets in texts: fixed rules, and strings that look random to Markov models.

Two models of characters, one of random strings and one of ordinary identifiers, are counted
from labelled samples. A run of key characters, or what the fixed rules leave of it, is a secret
if the logarithm of the likelihood ratio, per character, is over a threshold. Only DataFrame functions are used.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.sampling import sample

# The rules that every scan has, in the order of their kinds.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_CHARS = 12
KINDS = ("assign", "access", "hex")

MARKOV = "random"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Characters of the least run, or rest of a run, that is judged.
RUN_CHARS = 12
#: Whole runs of key characters; linear, since it starts at a run's start only.
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{RUN_CHARS},}}"
#: Runs that train neither model: the long ones with a digit, of which most keys are.
UNLEARNED = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
#: Other runs that are judged train the second model if so many documents hold them.
LEARNED_IN = 3
#: Documents whose identifiers train the second model, chosen by the hash of their ids.
TRAIN_ROWS = 2000
#: Weight, in transitions, of the frequencies of single characters in a model.
BACKOFF = 5.0
#: Mean logarithm of the likelihood ratio per character, for runs of so many characters or more.
THRESHOLD, SURE_CHARS = 0.5, 20
#: What each character less adds: words in capitals reach 1.7 in 13 characters, 0.6 in 15.
STRICTER = 0.2


def _spans(text: Column, rule: str, kind: str, rank: int, value: int | None = None, least: int = 0) -> Column:
    """Matches as structs ``start, rank, kind, end, value``: the pieces between them give the places."""
    found = F.struct(
        F.split(text, rule).alias("pieces"),
        F.regexp_extract_all(text, F.lit(rule), 0).alias("hits"),
        F.regexp_extract_all(text, F.lit(rule), 0 if value is None else value).alias("values"),
    )

    def step(state: Column, i: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["pieces"][i])
        end = start + F.char_length(x["hits"][i])
        hit = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            end.alias("end"),
            x["values"][i].alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(hit)).alias("out"))

    kind_of = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"
    none = F.array().cast(kind_of)

    def places(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(
            F.sequence(F.lit(0), F.size(x["hits"]) - 1), start, lambda s, i: step(s, i, x), lambda s: s["out"]
        )

    spans = F.when(text.rlike(rule), F.transform(F.array(found), places)[0]).otherwise(none)
    return F.filter(spans, lambda s: F.char_length(s["value"]) >= least) if least else spans


def _base(text: Column) -> Column:
    return F.concat(
        _spans(text, ASSIGN, "assign", 0, 2, ASSIGN_CHARS),
        _spans(text, ACCESS, "access", 1),
        _spans(text, HEX, "hex", 2),
    )


def _steps(value: Column) -> Column:
    """Numbers of the pairs of neighbouring characters; characters outside the alphabet are one."""
    numbers = F.transform(F.split(value, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))

    def pairs(x: Column) -> Column:
        n = F.size(x) - 1
        return F.zip_with(F.slice(x, 1, n), F.slice(x, 2, n), lambda a, b: a * (len(ALPHABET) + 1) + b)

    found = F.transform(F.array(numbers), pairs)[0]
    return F.when(F.char_length(value) > 1, found).otherwise(F.array().cast("array<int>"))


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> list[float]:
    """Logarithms of the ratio of the two models' transition probabilities, by pair of characters.

    The labelled samples come from at most ``rows`` documents: values that the fixed rules find
    and digests of the ids, which are random by construction, against the other identifiers.
    Of the runs that the models are to judge, only those train the second that several documents
    hold, and none that are long and have a digit.
    """
    chosen = sample(docs, rows)
    digest = F.sha2(F.concat(F.lit("key:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    made = F.array(F.base64(F.unhex(digest)), F.upper(F.base64(F.unhex(digest))), digest)
    caught = F.transform(_base(F.col("text")), lambda s: s["value"])
    labelled = chosen.select(caught.alias("caught"), made.alias("made"), "text").select(
        F.explode(F.concat("caught", "made")).alias("value"), F.lit(1).alias("random"), F.lit(1).cast("long").alias("n")
    )
    known = F.array_except(F.regexp_extract_all("text", F.lit(IDENTIFIER), 0), F.transform(_base(F.col("text")), lambda s: s["value"]))
    words = chosen.select(F.explode(known).alias("value"), F.lit(0).alias("random")).groupBy("value", "random").agg(F.count("*").alias("n"))
    learned = (F.col("n") >= LEARNED_IN) & ~F.col("value").rlike(UNLEARNED)
    words = words.filter(~F.col("value").rlike(CANDIDATE) | learned)
    pairs = labelled.unionByName(words).select("random", "n", F.explode(_steps(F.col("value"))).alias("pair"))
    counted = pairs.groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()  # at most two for each pair of characters

    n = len(ALPHABET) + 1
    counts = [[0] * (n * n), [0] * (n * n)]
    for row in counted:
        counts[row["random"]][row["pair"]] = row["n"]
    ordinary, random = map(_logarithms, counts)
    return [round(r - o, 6) for r, o in zip(random, ordinary)]


def _logarithms(counts: list[int]) -> list[float]:
    """Logarithms of a model's transition probabilities.

    Few or no transitions out of a character leave it the frequencies of the characters that
    follow any: capitals stay rare after capitals in a model that has seen none.
    """
    n = len(ALPHABET) + 1
    total = sum(counts)
    follows = [(sum(counts[b::n]) + 0.5) / (total + 0.5 * n) for b in range(n)]
    leaves = [sum(counts[a * n : (a + 1) * n]) for a in range(n)]
    return [
        math.log((counts[a * n + b] + BACKOFF * follows[b]) / (leaves[a] + BACKOFF)) for a in range(n) for b in range(n)
    ]


def ratio(value: Column, table: list[float]) -> Column:
    """Mean logarithm of the likelihood ratio over the value's pairs of characters."""
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")
    steps = _steps(value)
    total = F.aggregate(steps, F.lit(0.0), lambda a, p: a + ratios[p])
    return total / F.greatest(F.lit(1), F.char_length(value) - 1)


def _looks_random(value: Column, table: list[float]) -> Column:
    short = F.greatest(F.lit(0), SURE_CHARS - F.char_length(value))
    return ratio(value, table) > THRESHOLD + STRICTER * short


def _rest(run: Column, base: Column) -> Column:
    """The parts of a run that none of ``base``, sorted, covers, if they are long enough."""

    def part(start: Column, end: Column) -> Column:
        value = run["value"].substr(start - run["start"] + 1, end - start)
        return F.array(F.struct(start.alias("start"), run["rank"].alias("rank"), run["kind"].alias("kind"), end.alias("end"), value.alias("value")))

    def step(state: Column, b: Column) -> Column:
        out = F.when(b["start"] - state["at"] >= RUN_CHARS, F.concat(state["out"], part(state["at"], b["start"])))
        return F.struct(F.greatest(state["at"], b["end"]).alias("at"), out.otherwise(state["out"]).alias("out"))

    def last(state: Column) -> Column:
        out = F.when(run["end"] - state["at"] >= RUN_CHARS, F.concat(state["out"], part(state["at"], run["end"])))
        return out.otherwise(state["out"])

    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string>>")
    met = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    return F.aggregate(met, F.struct(run["start"].alias("at"), none.alias("out")), step, last)


def _joined(spans: Column) -> Column:
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, base_spans, spans`` of each whole text.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start and then by kind.
    The models judge runs of ``RUN_CHARS`` key characters or more, with or without digits, and
    the parts as long that spans of the fixed rules leave of them; spans of kind ``random`` never
    overlap those. The fewer characters, the surer the models must be.

    One row per input row, repeated rows and NULL ids included; a NULL text counts as empty,
    without spans. An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    table = train(texts)
    found = texts.select("doc_id", F.array_sort(_base(F.col("text"))).alias("base"), _spans(F.col("text"), CANDIDATE, MARKOV, 3).alias("runs"))

    parts = F.flatten(F.transform("runs", lambda r: _rest(r, F.col("base"))))
    random = F.filter(parts, lambda r: _looks_random(r["value"], table))
    found = found.select("doc_id", "base", random.alias("random"))

    def of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(of, KINDS),
        F.size("random").cast("long").alias("n_random"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("base")).alias("base_spans"),
        _joined(F.array_sort(F.concat("base", "random"))).alias("spans"),
    )
