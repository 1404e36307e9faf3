"""Language ID by cross-parsing entropy.

A suffix automaton of labelled text per language answers how far a text can be followed inside that language's text. A
text is cut into the fewest such phrases for each language (greedy longest matches), and the language that needs the
fewest phrases per symbol wins. All automata are stored as one table of transitions in which a missing transition holds
the start of the next phrase, so one lookup per symbol and language does a step, and numpy takes that step for many
blocks of text at once.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.shared import by_batches

UNKNOWN = "und"
#: The bounded sample of labelled rows: so many rows of each language at most, whole ones, as long as those before hold fewer than
#: so many characters, rows over so many characters last; and the number of languages learned, those with the most rows, by
#: name where equal.
SAMPLE_ROWS, SAMPLE_CHARS, LONG_ROW, LANGUAGES = 24, 32_000, 8_000, 200
#: Letters with a column in the table of transitions; other letters that were learned have their transitions in a sorted list,
#: and those never learned share a symbol. Symbol 0 is all that isn't a letter, in runs of one.
SYMBOLS = 60
#: A phrase ends where a block ends, so that the blocks of long texts can be followed side by side.
BLOCK = 512
#: Symbols that are followed at once.
LANES = 4_096


@functools.cache
def _letters() -> np.ndarray:
    """Of each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _collapsed(codes: np.ndarray) -> np.ndarray:
    """With one 0 for each run of 0s."""
    return codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]] if len(codes) else codes


def normal(text: str) -> np.ndarray:
    """Code points of lower-case letters, with 0 for each run of others."""
    points = _points(text)
    return _collapsed(np.where(_letters()[points], points, 0))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of each state; state 0 is the start, and every substring is a path from it."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class CrossParser:
    """Automata of all languages in one table.

    step[state + symbol] is the next state, already times the number of symbols; where no transition is, it is the
    complement of the state in which a new phrase stands after that symbol. Symbols from `width` on are the letters beyond
    the table: far_keys holds state * len(far) + letter in order, far_to what step would hold, and far_new[language, letter]
    stands for a missing one.
    """

    def __init__(self, samples: dict[str, list[str]], symbols: int = SYMBOLS):
        self.languages = sorted(samples)
        parts = {k: np.concatenate([np.r_[normal(x), np.uint32(0)] for x in samples[k]] or [np.empty(0, np.uint32)]) for k in self.languages}
        seen = Counter(int(c) for x in parts.values() for c in x if c)
        ranked = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))]
        self.letters, self.far = sorted(ranked[:symbols]), sorted(ranked[symbols:])
        self.width = len(self.letters) + 2
        tables, self.starts, base = [], [], 0
        keys, to_, news = [], [], []
        for k in self.languages:
            states = suffix_automaton(self.table[parts[k]].tolist())
            table = np.zeros((len(states), self.width), np.int64)
            first = np.array([states[0].get(c, 0) for c in range(self.width)], np.int64)
            table[:] = ~(base + first * self.width)
            for s, moves in enumerate(states[1:], 1):  # the start has none: what comes there begins a phrase
                for c, to in moves.items():
                    if c < self.width:
                        table[s, c] = base + to * self.width
                    else:
                        keys.append((base + s * self.width) * len(self.far) + c - self.width)
                        to_.append(base + to * self.width)
            news.append([~(base + states[0].get(self.width + c, 0) * self.width) for c in range(len(self.far))])
            tables.append(table.ravel())
            self.starts.append(base)
            base += table.size
        self.step = np.concatenate(tables).astype(np.int32 if base < 2**31 else np.int64) if tables else np.empty(0, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.far_keys, self.far_to = np.array(keys, np.int64)[order], np.array(to_, self.step.dtype)[order]
        self.far_new = np.array(news, self.step.dtype).reshape(len(self.languages), len(self.far))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    @functools.cached_property
    def table(self) -> np.ndarray:
        """The symbol of each code point: 0 for others than letters, 1 to n for the letters in the table, n + 1 for those never learned, more for the others."""
        table = np.where(_letters(), np.int32(self.width - 1), np.int32(0))
        table[np.array(self.letters, np.int64)] = np.arange(1, len(self.letters) + 1)
        table[np.array(self.far, np.int64)] = self.width + np.arange(len(self.far))
        return table

    def code(self, text: str) -> np.ndarray:
        return _collapsed(self.table[_points(text)])

    def _next(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """What follows the states, (languages, symbols), by the symbols: a state, or the complement of one that begins a phrase."""
        far = np.flatnonzero(symbols >= self.width) if self.far else ()
        if not len(far):
            return self.step[state + symbols]
        to = self.step[state + np.where(symbols < self.width, symbols, 0)]
        letters = symbols[far] - self.width
        keys = state[:, far].astype(np.int64) * len(self.far) + letters
        at = np.minimum(np.searchsorted(self.far_keys, keys), len(self.far_keys) - 1)
        to[:, far] = np.where(self.far_keys[at] == keys, self.far_to[at], self.far_new[:, letters]) if len(self.far_keys) else self.far_new[:, letters]
        return to

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """The number of phrases of each text in each language: (texts, languages)."""
        counts = np.zeros((len(codes), len(self.languages)), np.int64)
        flat = np.concatenate(codes) if codes else np.empty(0, np.int32)
        sizes = np.fromiter((len(c) for c in codes), np.int64, len(codes))
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(codes)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        size = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            state = np.repeat(np.array(self.starts, self.step.dtype)[:, None], len(lanes), axis=1)
            got = np.zeros(state.shape, np.int32)
            live, where = size[lanes], start[lanes]
            for i in range(int(live[0])):
                n = int(np.searchsorted(-live, -i, side="left"))
                to = self._next(state[:, :n], flat[where[:n] + i])
                ended = to < 0
                got[:, :n] += ended
                state[:, :n] = to ^ (to >> (to.dtype.itemsize * 8 - 1))
            np.add.at(counts, owner[lanes], got.T)
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and how much the next best lies behind, from 0 to 1."""
        codes = [self.code(x) if x else np.empty(0, np.int32) for x in texts]
        lettered = np.fromiter((bool(c.any()) for c in codes), bool, len(codes))
        score, names = np.zeros(len(codes)), [UNKNOWN] * len(codes)
        if not self.languages or not lettered.any():
            return names, score
        used = np.flatnonzero(lettered)
        rate = self.phrases([codes[i] for i in used]) / np.fromiter((len(codes[i]) for i in used), float)[:, None]
        best = rate.argmin(axis=1)  # ties: the first by name
        low = rate[np.arange(len(used)), best]
        rate[np.arange(len(used)), best] = np.inf
        second = rate.min(axis=1)
        score[used] = np.where(np.isinf(second), 1.0, 1 - low / second)
        for i, b in zip(used, best, strict=True):
            names[i] = self.languages[b]
        return names, np.clip(score, 0, 1)


def held_out(id_col: str = "doc_id"):
    """True for the rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(df: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = SAMPLE_ROWS) -> dict[str, list[str]]:
    """Texts by label, of up to `rows` rows of each label that is not held out, chosen by a hash of the id; see SAMPLE_CHARS.
    Of rows with one id, one counts.

    Two passes: the first reads ids and labels only and gives the hash bound of each label, so that the second brings little
    more than the sample to the driver.
    """
    label, text, id_ = (F.col(f"`{c}`") for c in (label_col, text_col, id_col))
    place = F.pmod(F.xxhash64(id_, F.lit("language sample")), F.lit(1 << 30))
    usable = df.where(~held_out(id_col) & label.isNotNull() & (label != UNKNOWN) & text.isNotNull()).select(label.alias("label"), text.alias("text"), place.alias("place"))
    counts = usable.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(LANGUAGES).collect()
    if not counts:
        return {}
    bound = F.create_map(*[F.lit(x) for r in counts for x in (r["label"], min(1 << 30, -(-(2 * rows << 30) // r["n"])))])
    chosen = usable.where(F.col("place") < F.element_at(bound, F.col("label"))).groupBy("label", "place").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    chosen = chosen.withColumn("chars", F.char_length("text").cast("long"))
    order = Window.partitionBy("label").orderBy(F.col("chars") > LONG_ROW, "place")  # of about twice the rows of the sample
    before = F.coalesce(F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = chosen.withColumns({"nth": F.row_number().over(order), "before": before}).where((F.col("nth") <= rows) & (F.col("before") < SAMPLE_CHARS))
    out: dict[str, list[str]] = {}
    for r in picked.select("label", "nth", "text").orderBy("label", "nth").collect():
        out.setdefault(r["label"], []).append(r["text"])
    return out


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> CrossParser:
    """The automata of the labelled rows of df that aren't held out."""
    return CrossParser(labelled_sample(df, id_col, text_col, label_col))


def _identified(df: DataFrame, parser: CrossParser, text_col: str, keep: list[str]) -> DataFrame:
    """c0, c1, ... for the columns `keep`, and lang_pred and score."""
    shipped = df.sparkSession.sparkContext.broadcast(parser)  # bounded by LANGUAGES and the rows of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                names, score = shipped.value.predict(part.column(at_text).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(score)], names=fields)

    fields = [*[f"c{i}" for i in range(len(keep))], "lang_pred", "score"]
    at_text = keep.index(text_col) if text_col in keep else len(keep)
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep if text_col in keep else [*keep, text_col])])
    schema = ", ".join([f"c{i} {plain.schema[i].dataType.simpleString()}" for i in range(len(keep))] + ["lang_pred string", "score double"])
    return by_batches(plain, run, schema)


def identify(df: DataFrame, parser: CrossParser, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (the id alone, if not given) with lang_pred and score, for every row of df.

    Whole texts count, whatever their length. A text that is null, empty or without a letter is `und` with score 0, and so
    is every text if nothing was learned. Ties go to the first language by name. Repeated rows have equal results, and an
    empty table gives an empty one.
    """
    keep = keep or [id_col]
    return _identified(df, parser, text_col, keep).toDF(*keep, "lang_pred", "score")


def known_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", least: float = 0.0) -> DataFrame:
    """The rows of df whose language is found with a score of `least` or more, with all their columns, whatever their names; a
    null label becomes the language found. Rows that are `und` go: null and empty texts, and those without a letter. Repeated
    rows stay or go together; an empty table gives an empty one."""
    found = _identified(df, train(df, id_col, text_col, label_col), text_col, df.columns).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[(F.coalesce(f"c{i}", "lang_pred") if c == label_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(df.columns)])


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
