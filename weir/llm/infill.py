"""Fill-in-the-middle: texts are cut into prefix, middle and suffix, and put together again in another order with marks.

A text is cut into its code points by a pre-tokenizer of the tokenizers library: Split, with the pattern of any one character
and each match isolated. Nothing is trained. The number of its offsets is the length n, and the offsets of two ranks, drawn
from a hash of the row's id, are the cuts. A match is one code point whatever stands beside it, so a text may be cut
piecewise, and the offsets of pieces that occurred before (mostly words) are remembered.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

#: What stands before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts that may be cut, so many are; and of those, so many begin with the suffix.
RATE, SUFFIX_FIRST = 90, 20
#: Code points of a piece at most, pieces remembered by a task, and bytes of texts in a batch that is returned.
PIECE, REMEMBERED, BATCH_BYTES = 256, 100_000, 4 << 20


class Cutter:
    """The code points of texts, by offsets."""

    def __init__(self) -> None:
        self.split = pre_tokenizers.Split(Regex(r"(?m:.)"), "isolated")
        self.known: dict[str, array] = {}

    def offsets(self, piece: str) -> array:
        """Where each code point of a short piece begins, and where the last ends."""
        found = self.known.get(piece)
        if found is None:
            spans = [span for _, span in self.split.pre_tokenize_str(piece)]
            found = array("H", [*[start for start, _ in spans], spans[-1][1] if spans else 0])
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        """The text in pieces, at its spaces, which lead the piece that follows; longer ones are cut at PIECE code points."""
        words = text.split(" ")
        if len(max(words, key=len)) < PIECE:
            return [words[0], *[" " + w for w in words[1:]]]
        out = []
        for i, w in enumerate(words):
            w = " " + w if i else w
            out += [w[k : k + PIECE] for k in range(0, len(w), PIECE)] or [w]
        return out

    def cut(self, text: str, *draws: int) -> tuple[int, list[int]]:
        """n, and for each draw x the offset of the code point of rank x % (n + 1); rank n is the end."""
        pieces = self.pieces(text)
        offsets = list(map(self.offsets, pieces))
        ranks = np.cumsum(np.fromiter(map(len, offsets), np.int64, len(offsets)) - 1)  # an array has an end besides its beginnings
        starts = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        n, places = int(ranks[-1]), []
        for x in draws:
            rank = x % (n + 1)
            k = min(int(np.searchsorted(ranks, rank, "right")), len(pieces) - 1)
            places.append(int(starts[k]) - len(pieces[k]) + offsets[k][rank - (int(ranks[k - 1]) if k else 0)])
        return n, places


def draws(seed: str, key: object) -> list[int]:
    """Four numbers of 32 bits for a row."""
    found = sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transformed(cutter: Cutter, text: str, h: list[int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """n, form, code points of the prefix and of the middle, and the output of one text."""
    n, (a, b) = cutter.cut(text, h[0], h[1])
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = min(a, b), max(a, b)
    before, inside, after = MARKS[0] + text[:a], text[a:b], MARKS[1] + text[b:]
    spm = h[3] % 100 < suffix_first
    return n, "spm" if spm else "psm", a, b - a, (after + before if spm else before + after) + MARKS[2] + inside


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row of df. form: psm (prefix, suffix, middle), spm (suffix, prefix,
    middle) or plain, the text as it is.

    The cuts and the form follow from seed and id alone, so reruns agree and rows of one id and text are transformed alike. A
    null text is an empty one; empty texts and those that hold a mark are plain, so that restored() is always exact; a null
    id draws as an empty one. Texts may have any length: beside a text itself there is one number for each of its pieces. Other
    columns may have any name; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):
                key, text = batch.column(1)[i].as_py(), batch.column(2)[i].as_py() or ""
                rows.append(transformed(cutter, text, draws(seed, key), rate, suffix_first))
                held += len(text)
                if held >= BATCH_BYTES or i == batch.num_rows - 1:
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i + 1 - len(rows), len(rows)), *cols], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
                    rows, held = [], 0

    key = F.col(f"`{id_col}`")
    plain = df.select(key.alias("id"), key.cast("string").alias("key"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form. Neither mark can begin inside a part, or across two."""
    p, s, m = MARKS
    psm = [F.substring(F.substring_index(output, s, 1), len(p) + 1, 2**31 - 1), F.substring_index(output, m, -1), F.substring_index(F.substring_index(output, m, 1), s, -1)]
    spm = [F.substring_index(F.substring_index(output, m, 1), p, -1), F.substring_index(output, m, -1), F.substring(F.substring_index(output, p, 1), len(s) + 1, 2**31 - 1)]
    return F.when(form == "psm", F.concat(*psm)).when(form == "spm", F.concat(*spm)).otherwise(output)


def op13_infill(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
e AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
  CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
       WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
f AS (SELECT *, substring(x, 1, least(a, b)) AS pre, substring(x, least(a, b) + 1, greatest(a, b) - least(a, b)) AS mid, substring(x, greatest(a, b) + 1) AS suf FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars, CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(x) AS restored_sha256 FROM f
"""
