"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The pass keeps a window of positions and, for each, the piece that ends there and where that piece starts. A position can
be left from no further than the longest piece, so whenever the back pointers of all positions that still can be left lead
to one boundary, the pieces before it are final: they are given out and forgotten.

In a unigram model the piece at a position is the one with the best sum of scores. In a BPE model the sum of scores does
not give that model's ids; there a piece may follow another only if the merges of their joint characters end in these two.
Since a sequence of pieces is what the merges give exactly if each two neighbours are, one piece is left for each position,
and the path is the model's own encoding.

The pieces that end at a position come from an automaton of the vocabulary. Where no piece holds a space after something
else, the place before a space is always a boundary, as is one between two characters that stand together in no piece; the
stretches between are encoded alike wherever they stand, so those lately met are remembered, and of short ones the pass over their first
characters.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.shared import by_batches

SPACE = "▁"
#: Entries of a memory before it becomes the old one, which is forgotten when the next is full; code points that are cut
#: into stretches at a time, and positions between two looks for a boundary.
MEMORY, SLICE, LOOK = 150_000, 1 << 20, 16
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: A run of up to SHORT characters is passed over whole; how many of its first characters stand for what is remembered of the pass
#: over them, and of how many such beginnings.
SHORT, HEAD, HEADS = 64, 5, 50_000
STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
WORD = re.compile(rf"{SPACE}*[^\W\d_]+")


class Pieces:
    """A vocabulary with its encoder and decoder. pieces: (piece, score, type) by id; bpe: a BPE model, else unigram."""

    def __init__(self, pieces: list[tuple[str, float, int]], bpe: bool, dummy_prefix: bool = True, squeeze: bool = False, byte_fallback: bool = True):
        if any(kind == USER for _, _, kind in pieces):
            raise ValueError("user-defined pieces aren't supported")
        self.names, self.bpe, self.dummy_prefix, self.squeeze = [p for p, _, _ in pieces], bpe, dummy_prefix, squeeze
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, UNUSED)}
        self.score = {p: s for p, s, kind in pieces if kind in (NORMAL, UNUSED)}
        self.kinds = [kind for _, _, kind in pieces]
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE} if byte_fallback else {}
        self.longest = max(map(len, self.ids), default=1)
        self._fits: dict[str, dict[str, bool]] = {}
        self._n_fits = self._n_moves = 0
        self.pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self._automaton()
        self._shown = [p.replace(SPACE, " ") for p in self.names]
        self._plain = np.array([k in (NORMAL, UNUSED) for k in self.kinds] or [False])
        self.cut_at_space = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.fallback = min(self.score.values(), default=0.0) - 10
        self._known, self._old, self._heads = {}, {}, {}
        self._raw = {p: array("i", [i]).tobytes() for p, i in self.ids.items()}

    @classmethod
    def load(cls, path: str) -> Pieces:
        """The vocabulary of a SentencePiece model file whose normalizer is the identity."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.normalizer_spec.precompiled_charsmap:
            raise ValueError("the model's normalizer changes characters")
        if model.trainer_spec.model_type not in (1, 2) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with white space before words are supported")
        rows = [(p.piece, p.score, p.type) for p in model.pieces]
        return cls(rows, model.trainer_spec.model_type == 2, model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces, model.trainer_spec.byte_fallback)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}, "_old": {}, "_heads": {}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        gc.freeze()  # a worker keeps the vocabulary, so its garbage collector need not walk it again and again

    def merged(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges: the best score first, the leftmost of equal ones."""
        score = self.score
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def fits(self, left: str, right: str) -> bool:
        """Whether a piece may follow another ("": the start of the text)."""
        after = self._after(left)
        known = after.get(right)
        if known is None:
            if self._n_fits >= MEMORY:
                for x in self._fits.values():
                    x.clear()
                self._n_fits = 0
            known = after[right] = self.merged(list(left + right)) == ([left, right] if left else [right])
            self._n_fits += 1
        return known

    def _after(self, left: str) -> dict[str, bool]:
        """What is known of the pieces that may follow this one."""
        after = self._fits.get(left)
        if after is None:
            after = {}
            if left in self.ids or not left:  # what is kept is bounded by the vocabulary
                self._fits[left] = after
        return after

    def _automaton(self) -> None:
        """The pieces in a trie with links to the longest suffix that it also holds. moves[c][state] is where character c leads;
        ends[state] the pieces that end there, the longest first, with their lengths and what may follow them."""
        nexts: dict[str, set[str]] = {}
        for p in self.ids:
            for i in range(len(p)):
                nexts.setdefault(p[:i], set()).add(p[i])
        moves: dict[str, dict[int, int]] = {}
        link, ends, level = [0], [()], {"": 0}
        while level:
            below = {}
            for head, state in level.items():
                for c in nexts.get(head, ()):
                    to, up, way = len(link), link[state], moves.setdefault(c, {})
                    while up and up not in way:
                        up = link[up]
                    link.append(way.get(up, 0) if state else 0)
                    way[state] = to
                    own = ((head + c, len(head) + 1, self._after(head + c)),) if head + c in self.ids else ()
                    ends.append(own + ends[link[to]])
                    below[head + c] = to
            level = below
        self._moves, self._link, self._ends = moves, link, ends

    def _move(self, way: dict[int, int], state: int) -> int:
        """Where a character leads from a state that has no move of its own by it."""
        up = self._link[state]
        while up and up not in way:
            up = self._link[up]
        to = way.get(up, 0)
        if self._n_moves < MEMORY:
            way[state] = to
            self._n_moves += 1
        return to

    def path(self, text: str) -> Iterator[str]:
        """The pieces of a text, given out as soon as they are final."""
        for some in self._path(text):
            yield from some

    def _path(self, text: str) -> Iterator[list[str]]:
        return self._path_bpe(text) if self.bpe else self._path_unigram(text)

    @staticmethod
    def _shared(start: list[int], upto: int, longest: int) -> int:
        """The last boundary that the back pointers of all places lead to from which a piece can still end after upto."""
        live = set(range(max(0, upto - longest + 1), upto + 1))
        while len(live) > 1:
            far = max(live)
            live.discard(far)
            live.add(start[far])
        return live.pop()

    @staticmethod
    def _back(text: str, start: list[int], end: int) -> list[str]:
        """The pieces that lead from the first to the last place of text."""
        out = []
        while end:
            at = start[end]
            out.append(text[at:end])
            end = at
        out.reverse()
        return out

    def _path_bpe(self, text: str) -> Iterator[list[str]]:
        """At each character the pieces that end there are asked from the longest on; the first that may follow the piece which
        ends where it begins is the one. The lists hold the window: place i is position base + i."""
        moves, ends, longest, whole = self._moves, self._ends, self.longest, len(text)
        after, start, here, base, state, before = [self._after("")], [0], 0, 0, 0, ""
        for c in text:
            here += 1
            way = moves.get(c)
            if way is None:
                state = 0
            else:
                to = way.get(state)
                state = self._move(way, state) if to is None else to
            for piece, n, follow in ends[state]:
                if n <= here:
                    at = here - n
                    ok = after[at].get(piece)
                    if ok or ok is None and self.fits(text[base + start[at] : base + at] if at else before, piece):
                        break
            else:
                at, follow = here - 1, self._after(c)
            start.append(at)
            after.append(follow)
            if here >= LOOK and not here % LOOK and base + here < whole:
                end = self._shared(start, here, longest)
                if end:
                    out = self._back(text[base : base + end], start, end)
                    yield out
                    before, base, here = out[-1], base + end, here - end
                    after, start = after[end:], [max(0, i - end) for i in start[end:]]
        yield self._back(text[base:], start, here)

    def _short_bpe(self, run: str) -> list[str]:
        """The pieces of a short run, as _path_bpe gives them. Words begin alike, and the pass over a beginning doesn't depend on what
        follows, so it is taken up where one over the same beginning stood."""
        head = run[:HEAD]
        known = self._heads.get(head)
        if known is None:
            start, after = [0], [self._after("")]
            state = self._on(head, 0, 0, start, after)
            if len(self._heads) >= HEADS:
                self._heads.clear()
            known = self._heads[head] = state, start, after
        state, start, after = known
        if len(run) > HEAD:
            start, after = start.copy(), after.copy()
            self._on(run, HEAD, state, start, after)
        return self._back(run, start, len(run))

    def _on(self, text: str, here: int, state: int, start: list[int], after: list[dict[str, bool]]) -> int:
        """Passes over the characters of text from place `here` on; gives the state there."""
        moves, ends = self._moves, self._ends
        for c in text[here:]:
            here += 1
            way = moves.get(c)
            if way is None:
                state = 0
            else:
                to = way.get(state)
                state = self._move(way, state) if to is None else to
            for piece, n, follow in ends[state]:
                at = here - n
                if at >= 0:
                    ok = after[at].get(piece)
                    if ok or ok is None and self.fits(text[start[at] : at], piece):
                        break
            else:
                at, follow = here - 1, self._after(c)
            start.append(at)
            after.append(follow)
        return state

    def _path_unigram(self, text: str) -> Iterator[list[str]]:
        """The best sum of scores; of equal ones the longest last piece."""
        moves, ends, score, longest, whole = self._moves, self._ends, self.score, self.longest, len(text)
        best, start, here, base, state = [0.0], [0], 0, 0, 0
        for c in text:
            here += 1
            way = moves.get(c)
            if way is None:
                state = 0
            else:
                to = way.get(state)
                state = self._move(way, state) if to is None else to
            most = None
            for piece, n, _ in ends[state] if c in score else (*ends[state], (c, 1, None)):
                if n <= here and (most is None or best[here - n] + score.get(piece, self.fallback) > most):
                    most, at = best[here - n] + score.get(piece, self.fallback), here - n
            best.append(most)
            start.append(at)
            if here >= LOOK and not here % LOOK and base + here < whole:
                end = self._shared(start, here, longest)
                if end:
                    yield self._back(text[base : base + end], start, end)
                    base, here = base + end, here - end
                    best, start = best[end:], [max(0, i - end) for i in start[end:]]
        yield self._back(text[base:], start, here)

    def _number(self, piece: str) -> list[int]:
        """The ids of a character that is no piece."""
        raw = piece.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if len(self.bytes) == 256 else [self.unknown]

    def _keep(self, text: str, ids: bytes) -> bytes:
        if len(text) <= 64:
            if len(self._known) >= MEMORY:
                self._old, self._known = self._known, {}
            self._known[text] = ids
        return ids

    def _run(self, run: str) -> bytes:
        """The ids of a run of characters between two sure boundaries: as remembered, or by a pass over it."""
        known = self._known.get(run)
        if known is not None:
            return known
        known = self._old.get(run)
        if known is None and self.bpe and len(run) <= SHORT:
            found, raw = self._short_bpe(run), self._raw
            try:
                known = b"".join([raw[p] for p in found])
            except KeyError:  # of a character that is no piece
                known = b"".join([raw[p] if p in raw else array("i", self._number(p)).tobytes() for p in found])
        elif known is None:
            ids, own = array("i"), self.ids
            for some in self._path(run):
                for p in some:
                    one = own.get(p)
                    if one is None:
                        ids.extend(self._number(p))
                    else:
                        ids.append(one)
            known = ids.tobytes()
        return self._keep(run, known)

    def _stretch(self, stretch: str) -> bytes:
        """The ids of a stretch. Where a word ends in characters that no piece joins to its last letter, both are runs."""
        if known := self._old.get(stretch):
            return self._keep(stretch, known)
        m = WORD.match(stretch)
        at = m.end() if m else 0
        if not 0 < at < len(stretch) or stretch[at - 1 : at + 1] in self.pairs:
            return self._run(stretch)
        return self._keep(stretch, self._run(stretch[:at]) + self._run(stretch[at:]))

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as int32 bytes."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return b""
        text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        if not self.cut_at_space:
            return self._stretch(text)
        parts, at, find = [], 0, STRETCH.findall
        while at < len(text):
            end = len(text)
            if end - at > SLICE:  # up to a space that follows something else
                m = re.compile(f"(?<=[^{SPACE}]){SPACE}").search(text, at + SLICE)
                end = m.start() if m else end
            known = self._known.get
            parts += [known(x) or self._stretch(x) for x in find(text[at:end])]
            at = end
        return b"".join(parts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids, null for null. Control pieces are nothing, bytes are joined, and ids that are null or
        not in the vocabulary are unknown."""
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        known = (ids >= 0) & (ids < len(self.names))
        plain = known & self._plain[np.where(known, ids, 0)]
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        offsets = pa.array(np.r_[starts, len(ids)].astype(np.int32), mask=np.r_[lists.is_null().to_numpy(zero_copy_only=False), False])
        shown = pa.array(self._shown, pa.string()).take(pa.array(np.where(plain, ids, 0)))
        out = pc.binary_join(pa.ListArray.from_arrays(offsets, shown), "")
        owner = np.repeat(np.arange(len(sizes)), sizes)
        odd = np.unique(owner[~plain])
        if len(odd):
            out = out.to_pylist()
            for i in odd:
                out[i] = self._decode_each(ids[starts[i] : starts[i] + sizes[i]].tolist())
            out = pa.array(out, pa.string())
        return pc.replace_substring_regex(out, "^ ", "", max_replacements=1) if self.dummy_prefix else out

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        return self.decode_lists(pa.array([ids], pa.list_(pa.int64())))[0].as_py()

    def _decode_each(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        kinds, n = self.kinds, len(self.names)
        for i in ids:
            kind = kinds[i] if 0 <= i < n else UNKNOWN
            if kind == BYTE:
                raw.append(int(self.names[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(self._shown[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")


def _lists(found: list[bytes], texts: list[str | None]) -> pa.ListArray:
    """int32 bytes as lists, null where the text is."""
    ends = np.cumsum([0] + [len(x) // 4 for x in found]).astype(np.int32)
    offsets = pa.array(ends, mask=np.array([*(x is None for x in texts), False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), np.int32)))


def _by_rows(df: DataFrame, col: str, out: list[tuple[str, str]], of) -> DataFrame:
    """df and the columns `out` (name, type): of(values of col) gives their arrays. Columns of these names are replaced."""
    names = [n for n, _ in out]
    rest = [c for c in df.columns if c not in names or c == col]
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    at = rest.index(col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 128):
                batch = whole.slice(k, 128)
                cols = [*batch.columns, *of(batch.column(at))]
                yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])

    schema = ", ".join([f"c{i} {x.dataType.simpleString()}" for i, x in enumerate(plain.schema)] + [f"c{len(rest) + i} {t}" for i, (_, t) in enumerate(out)])
    found = by_batches(plain, run, schema).toDF(*rest, *[f"__new{i}" for i in range(len(out))])
    return found.select(*[F.col(f"`{c}`") for c in rest if c not in names], *[F.col(f"__new{i}").alias(n) for i, n in enumerate(names)])


def encode(df: DataFrame, pieces: Pieces, text_col: str = "text", out: str = "ids") -> DataFrame:
    """df and a column `out`: array<int> of each whole text's ids. A null text has null, an empty one no ids; rows stand
    alone, so ties, repeated rows and hot keys change nothing, and an empty table gives an empty one. A column named `out` is
    replaced; other columns may have any name."""
    shipped = df.sparkSession.sparkContext.broadcast(pieces)  # bounded by the vocabulary

    def of(texts: pa.Array) -> list[pa.Array]:
        values = texts.to_pylist()
        return [_lists([b"" if x is None else shipped.value.encode_bytes(x) for x in values], values)]

    return _by_rows(df, text_col, [(out, "array<int>")], of)


def decode(df: DataFrame, pieces: Pieces, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """df and a column `out`: the text of each row's ids; null for null, an empty text for no ids. Ids that are null or not in
    the vocabulary are unknown. Rows stand alone, and an empty table gives an empty one. A column named `out` is replaced."""
    shipped = df.sparkSession.sparkContext.broadcast(pieces)

    def of(lists: pa.Array) -> list[pa.Array]:
        return [shipped.value.decode_lists(lists)]

    return _by_rows(df, ids_col, [(out, "string")], of)


#: Where the model of the query is, unless spark.weir.pieces names another.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def model_of(spark) -> Pieces:
    return Pieces.load(spark.conf.get("spark.weir.pieces", MODEL))


def tokens(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, n_ids, round_trip) for every row: encode and decode in one pass over the texts. round_trip says whether
    the ids give the very text again, which they don't where it holds the character that stands for a space.

    A null text has null ids, n_ids 0 and comes back as null, an empty one has no ids. Rows stand alone: null and repeated
    ids, ties and equal texts are rows like others, and an empty table gives an empty one."""
    shipped = docs.sparkSession.sparkContext.broadcast(pieces)

    def of(texts: pa.Array) -> list[pa.Array]:
        one, values = shipped.value, texts.to_pylist()
        ids = _lists([b"" if x is None else one.encode_bytes(x) for x in values], values)
        same = pc.fill_null(pc.equal(one.decode_lists(ids), texts), True)
        return [ids, pc.cast(pc.fill_null(pc.list_value_length(ids), 0), pa.int64()), same]

    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = _by_rows(plain, "text", [("ids", "array<int>"), ("n_ids", "long"), ("round_trip", "boolean")], of)
    return found.select(F.col("id").alias(id_col), "ids", "n_ids", "round_trip")


def op2_pieces(spark, sf_dir: str) -> DataFrame:
    return tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_of(spark))
