"""Secret scans: fixed patterns, and character Markov models for what no pattern names.

Two first-order Markov models over characters, one of random strings and one of ordinary identifiers, are trained from
labelled samples: the secrets that patterns name in a bounded number of documents and their ordinary long words, besides
generated ones. Their log-likelihood ratio is a table with one number for each pair of characters, which goes into the
query as a literal; the sum over a candidate's pairs says which model made it. All of it runs as SQL expressions, and all
of it takes time in proportion to a text's length and matches.
"""

from __future__ import annotations

import functools
import math
import random
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns, in the order that kinds have: (kind, pattern, group whose length counts, least length).
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
#: Strings that the models judge, and the class of characters outside of them.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
MARKOV = "markov"
ALPHABET = string.ascii_letters + string.digits + "+/_-"
#: Log-likelihood ratio for each pair that a candidate must reach on average.
MARGIN = 0.35
#: Strings of each label that a model is trained from, generated and found, and documents that strings are looked for in.
SAMPLE, TRAIN_ROWS = 4_000, 2_000

#: Words that identifiers are made of, for the sample of ordinary ones.
WORDS = (
    "account action active address agent amount array async attribute author average backup balance batch block body boolean border "
    "bottom branch broker buffer build button cache callback cancel canvas category center channel character check child class client "
    "cluster code collection color column command comment commit common complete component config connection console container content "
    "context control convert cookie count create current cursor customer data database date default delete deploy description design "
    "detail device dialog digest directory display document domain download driver edge editor element email empty enable encoding "
    "engine entity entry environment error event example exception execute export expression extension factory failure feature field "
    "file filter final find first folder font footer form format forward frame function gateway generate global graph group handler "
    "header height hidden history host icon identifier image import index info init inner input insert instance integer interface "
    "internal invalid item iterator join kernel label language last layer layout length level library limit line link list listener load "
    "local location lock logger login loop manager map margin mask match matrix member memory menu merge message metadata method metric "
    "middleware migration model module monitor mouse name native network node normal notification number object offset open operator "
    "option order origin output owner package padding page panel parameter parent parse partition password path pattern payment pending "
    "permission phone picker pipeline plugin point policy pool position prefix preview previous price primary print priority private "
    "process product profile progress project property protocol provider proxy public query queue radius random range reader record "
    "redirect reference refresh region register release remote remove render report request reset resource response result return "
    "review role root route runtime sample schedule schema scope score screen script scroll search section select sender sequence "
    "server service session setting shadow shape share signal simple size socket source space stack start state static status step "
    "storage store stream string style submit subscription success summary support switch symbol sync system table target task template "
    "test text theme thread time title toggle token total trace track transaction transfer transform tree trigger type update upload url "
    "user utility validate value variable vector vendor version video view visible volume wait warning widget width window worker "
    "wrapper write zone"
).split()


@functools.cache
def samples(n: int = SAMPLE, seed: int = 7) -> tuple[list[str], list[str]]:
    """Labelled samples: (random strings, ordinary identifiers), the same on every call."""
    rng = random.Random(seed)
    kinds = [ALPHABET, string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, string.digits + "abcdef"]
    noise = ["".join(rng.choices(kinds[i % len(kinds)], k=rng.randint(20, 60))) for i in range(n)]
    styles = [
        lambda w: "_".join(w), lambda w: "-".join(w), lambda w: "/".join(w), lambda w: "_".join(w).upper(),
        lambda w: w[0] + "".join(x.title() for x in w[1:]), lambda w: "".join(x.title() for x in w), lambda w: "".join(w),
        lambda w: "_".join([*w, str(rng.randint(0, 2030))]),
    ]
    plain = [styles[i % len(styles)](rng.choices(WORDS, k=rng.randint(2, 6))) for i in range(n)]
    return noise, plain


def _chain(sample: list[str]) -> list[list[float]]:
    """Log probabilities of each next character, with half an occurrence added to each."""
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = [[0.5] * len(ALPHABET) for _ in ALPHABET]
    for text in sample:
        for a, b in zip(text, text[1:], strict=False):
            counts[place[a]][place[b]] += 1
    return [[math.log(x / sum(row)) for x in row] for row in counts]


@functools.cache
def ratios(noise: tuple[str, ...] = (), plain: tuple[str, ...] = ()) -> tuple[int, ...]:
    """Log-likelihood ratios of pairs of characters, in thousandths, row by row: over 0 if random is likelier. The models are
    trained from the generated samples and the strings given."""
    chains = [_chain([*own, *more]) for own, more in zip(samples(), (noise, plain), strict=True)]
    return tuple(round(1000 * (a - b)) for x, y in zip(*chains, strict=True) for a, b in zip(x, y, strict=True))


def score(text: str, table: tuple[int, ...] | None = None) -> float:
    """The mean ratio of a candidate's pairs, as the query computes it."""
    table, at = table or ratios(), [ALPHABET.index(c) for c in text]
    return sum(table[a * len(ALPHABET) + b] for a, b in zip(at, at[1:], strict=False)) / 1000 / max(1, len(text) - 1)


#: Matches that are gone through together; the time they take grows with their number times this one.
BLOCK = 128


def _walk(items: Column, state: Column, step, out: str) -> Column:
    """array<out> of what step(state, item) gives besides the next state, in order. Items are gone through in blocks, so that
    arrays that grow are short or few."""
    none = F.array().cast(f"array<{out}>")

    def block(all_: Column, state: Column, b: Column) -> Column:
        part = F.slice(all_, b * BLOCK + 1, F.lit(BLOCK))
        return F.aggregate(part, F.struct(state.alias("s"), none.alias("o")), lambda a, x: (lambda r: F.struct(r[0].alias("s"), F.concat(a["o"], F.array(r[1])).alias("o")))(step(a["s"], x)))

    def blocks(all_: Column) -> Column:
        rest = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.size(all_) / BLOCK).cast("int")))
        done = F.aggregate(rest, F.array(block(all_, state, F.lit(0))), lambda acc, b: F.concat(acc, F.array(block(all_, F.element_at(acc, -1)["s"], b))))
        return F.flatten(F.transform(done, lambda r: r["o"]))

    # the items are bound to a variable, not found again for each block
    return F.get(F.transform(F.array(items), blocks), F.lit(0))


SPAN = "struct<start:int,rank:int,kind:string,end:int,text:string>"


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> tuple[Column, Column]:
    """array<struct<start, rank, kind, end, text>> of the leftmost non-overlapping matches, in code points, and an empty one.

    The gaps between the matches are what a split by the same pattern leaves, so the running sum of the lengths of gaps and
    matches gives the places.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = whole if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(whole.alias("w"), F.slice(gaps, F.lit(1), F.size(whole)).alias("g"), F.transform(counted, lambda c: F.char_length(c)).alias("c"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start, end = at + x["g"], at + x["g"] + F.char_length(x["w"])
        return end, F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), F.when(x["c"] >= least, x["w"]).alias("text"))

    return F.filter(_walk(zipped, F.lit(0), step, SPAN), lambda x: x["text"].isNotNull()), F.array().cast(f"array<{SPAN}>")


def _apart(spans: Column, rank: int) -> Column:
    """The spans, sorted by start, without those of this rank that touch another rank's."""

    def seen(forward: bool):
        def step(edge: Column, x: Column) -> tuple[Column, Column]:
            own = x["rank"] == rank
            far = F.greatest(edge, x["end"]) if forward else F.least(edge, x["start"])
            touched = (edge > x["start"]) if forward else (edge < x["end"])
            return F.when(own, edge).otherwise(far), F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end"), F.when(~(own & touched), x["text"]).alias("text"))

        return step

    for forward in (True, False):
        spans = _walk(spans if forward else F.reverse(spans), F.lit(0 if forward else (1 << 31) - 1), seen(forward), SPAN)
        spans = F.filter(spans, lambda x: x["text"].isNotNull())
    return F.reverse(spans)


def _random_looking(text: Column, margin: float, table: tuple[int, ...]) -> Column:
    """Whether the ratios of a candidate's pairs reach the margin on average."""
    table = F.array(*[F.lit(x) for x in table])
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    size = F.size(codes)
    total = F.aggregate(
        F.slice(codes, F.lit(2), size),
        F.struct(F.element_at(codes, 1).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.element_at(table, acc["last"] * len(ALPHABET) + c + 1)).alias("sum")),
        lambda acc: acc["sum"],
    )
    return total >= F.lit(round(1000 * margin)) * (size - 1)


def _base(text: Column) -> list[Column]:
    """The spans of each kind of BASE."""
    low = F.lower(text)
    gates = [
        functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")]),
        F.contains(text, F.lit("AKIA")),
        text.rlike(r"[0-9a-f]{16}"),
    ]
    return [F.when(gate, spans).otherwise(empty) for i, (gate, kind) in enumerate(zip(gates, BASE, strict=True)) for spans, empty in [_spans(text, i, *kind)]]


def trained(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, strings: int = SAMPLE) -> tuple[int, ...]:
    """ratios() with the labelled strings of about `rows` documents, chosen by a hash of id and text, besides the generated
    ones: up to `strings` secrets that patterns name, and as many words of 8 letters and more."""
    n = df.count()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    place = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), text, F.lit("secrets")), F.lit(1 << 30))
    some = df.where(place < min(1 << 30, -(-(rows << 30) // max(1, n)))).select(text.alias("text")).limit(4 * rows)
    found = some.select(F.concat(*_base(F.col("text"))).alias("f"), F.regexp_extract_all("text", F.lit(r"\b([A-Za-z]{8,})\b"), F.lit(1)).alias("w"))
    value = F.regexp_extract(F.col("x.text"), r"([A-Za-z0-9+/_-]+)=*$", 1)
    noise = found.select(F.explode("f").alias("x")).select(value.alias("v")).where(F.char_length("v") >= 12)
    plain = found.select(F.explode("w").alias("v"))
    drawn = lambda x: tuple(sorted(r["v"] for r in x.distinct().orderBy(F.xxhash64("v")).limit(strings).collect()))
    return ratios(drawn(noise), drawn(plain))


def scan(df: DataFrame, text_col: str = "text", margin: float = MARGIN, out: str = "found", table: tuple[int, ...] | None = None) -> DataFrame:
    """df and a column `out`: array<struct<start, kind, end, text>> of all secrets in the whole text, sorted by start, then
    kind as listed (assign, access, hex, markov). table: the ratios, of trained() or, if not given, of generated samples.

    A kind's matches don't overlap; those of different kinds may, but for markov, which leaves out candidates that touch
    another span. Null and empty texts have an empty array. Each row stands alone: ties, repeated rows and hot keys change
    nothing, and an empty table gives an empty one. A column named `out` is replaced; others may have any name.
    """
    rest = [c for c in df.columns if c != out]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("all"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    named = packed.withColumn("base", F.concat(*_base(F.col("text"))))
    spans, empty = _spans(F.col("text"), len(BASE), MARKOV, CANDIDATE, 0, 20)
    named = named.withColumn("more", F.when(F.col("text").rlike(CANDIDATE), spans).otherwise(empty))
    likely = F.filter("more", lambda x: _random_looking(x["text"], margin, table or ratios()))
    both = F.array_sort(F.concat("base", F.when(F.size("more") > 0, likely).otherwise(empty)))
    both = F.when(F.size("more") > 0, _apart(both, len(BASE))).otherwise(both)
    found = F.transform(both, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["text"].alias("text")))
    return named.select("all.*", F.when(F.size("base") + F.size("more") > 0, found).otherwise(F.array().cast("array<struct<start:int,kind:string,end:int,text:string>>")).alias(out))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first one names the place."""

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        cut = F.concat(F.substring(text, at + 1, x["start"] - at), F.lit("["), x["kind"], F.lit("]"))
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, cut).otherwise("")

    done = F.array_join(_walk(spans, F.lit(0), step, "string"), "")
    return F.when(F.size(spans) > 0, F.concat(done, F.substring(text, F.array_max(F.transform(spans, lambda x: x["end"])) + 1, F.char_length(text)))).otherwise(text)


def redact(df: DataFrame, text_col: str = "text", margin: float = MARGIN, table: tuple[int, ...] | None = None) -> DataFrame:
    """df with all secrets in text_col replaced by the kind in brackets. Null texts stay null, empty ones empty; all other
    columns stay, whatever their names. Repeated rows are treated alike, and an empty table gives an empty one."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("all"), F.col(f"`{text_col}`").alias("text"))
    found = scan(packed, "text", margin, "found", table).withColumn("text", redacted(F.col("text"), F.col("found")))
    return found.select(*[(F.col("text") if c == text_col else F.col("all").getField(c)).alias(c) for c in df.columns])


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, table=trained(docs))
    base = F.filter(F.col("found"), lambda x: x["kind"] != MARKOV)
    count = lambda k: F.size(F.filter(F.col("found"), lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), count(MARKOV).alias("n_markov"))
