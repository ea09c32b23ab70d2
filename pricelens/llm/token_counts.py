"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole.  Tokens of a byte-level vocabulary
tile the text's bytes, so running sums of token lengths are their spans; an
interval join of these sorted spans with the sections' spans gives every
token's bytes in every section.

Rule for tokens that cross a boundary: a token counts for the section that
holds most of its bytes, ties for the section that begins first.  A token with
no byte in a section counts as unattributed, so the sections' counts and the
unattributed ones add up to the document's.

Everything happens in the document's own row: no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Vocabulary

_SECTIONS = "array<struct<name:string,start:int,end:int,n_tokens:long>>"


def line_sections(text: str) -> list[tuple[str, int, int]]:
    """(number, start, end) in characters of each line with its line end."""
    out, at = [], 0
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        out.append((str(len(out)), at, end))
        at = end
    return out


def byte_places(text: str, raw: bytes, chars: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets (those beyond the text: its end)."""
    if len(raw) == len(text):
        return np.clip(chars, 0, len(raw))
    first = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.append(first, len(raw))[np.clip(chars, 0, len(text))]


def attribute(ends: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Section of each token (-1: none).  ``ends`` are the tokens' ascending ends
    (the first begins at 0), sections are byte spans in any order."""
    begins = np.concatenate(([0], ends[:-1]))
    best, most = np.full(len(ends), -1, dtype=np.int64), np.zeros(len(ends), dtype=np.int64)
    for s in np.lexsort((end, start)).tolist():
        # tokens that touch the section: a run, as both are sorted
        lo = np.searchsorted(ends, start[s], "right")
        hi = np.searchsorted(begins, end[s], "left")
        if hi <= lo:
            continue
        run = slice(lo, hi)
        share = np.minimum(ends[run], end[s]) - np.maximum(begins[run], start[s])
        more = share > most[run]
        best[run][more] = s
        most[run][more] = share[more]
    return best


def _count(vocab: Vocabulary, has_sections: bool):
    own: dict = {}

    def run(batches):
        if "e" not in own:
            own["e"] = vocab.encoder()
            _, off = vocab.byte_table()
            own["size"] = np.diff(off)
        encode, size = own["e"].encode_ordinary, own["size"]
        for b in batches:
            total, none, rows = [], [], []
            given = b.column("sections").to_pylist() if has_sections else [None] * b.num_rows
            for text, listed in zip(b.column("text"), given):
                t = text.as_py() or ""
                raw = t.encode()
                ends = np.cumsum(size[np.array(encode(t), dtype=np.int64)])
                if has_sections:
                    spans = [(s["name"], s["start"], s["end"]) for s in listed or [] if s is not None
                             and s["start"] is not None and s["end"] is not None]
                else:
                    spans = line_sections(t)
                edge = byte_places(t, raw, np.array([s[1:] for s in spans], dtype=np.int64).reshape(-1, 2))
                at = attribute(ends, edge[:, 0], edge[:, 1])
                n = np.bincount(at + 1, minlength=len(spans) + 1)
                total.append(len(ends))
                none.append(int(n[0]))
                rows.append([{"name": s[0], "start": s[1], "end": s[2], "n_tokens": k}
                             for s, k in zip(spans, n[1:].tolist())])
            kind = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                       ("n_tokens", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(total, pa.int64()), pa.array(none, pa.int64()),
                 pa.array(rows, kind)], names=["doc_id", "n_tokens", "unattributed", "sections"])
    return run


def section_tokens(docs: DataFrame, vocab: Vocabulary, *, id_col: str = "doc_id",
                   text_col: str = "text", sections_col: str | None = None) -> DataFrame:
    """One row per document: (doc_id, n_tokens long, unattributed long, sections
    array<struct<name, start, end, n_tokens>>).

    ``sections_col`` is an array<struct<name string, start int, end int>> of
    character spans (end exclusive; they may leave gaps, overlap or be NULL);
    without it sections are the text's lines with their line ends, named by
    number.  A NULL or empty text has no tokens and no lines; given sections
    count 0.  Spans beyond the text are cut to it.  Rows that repeat an id or
    have none count each.
    """
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    if sections_col is not None:
        cols.append(F.col(sections_col).alias("sections"))
    return docs.select(*cols).mapInArrow(
        _count(vocab, sections_col is not None),
        f"doc_id long, n_tokens long, unattributed long, sections {_SECTIONS}")


def sections_of(docs: DataFrame, sections: DataFrame, *, id_col: str = "doc_id",
                out: str = "sections") -> DataFrame:
    """``docs`` with an array column ``out`` of their rows in a section table
    (id, name, start, end), for ``sections_col``; documents without rows get NULL."""
    rows = sections.groupBy(F.col(id_col).alias("_section_of")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("name").cast("string").alias("name"),
                                             F.col("start").cast("int").alias("start"),
                                             F.col("end").cast("int").alias("end")))).alias(out))
    return docs.join(rows, docs[id_col] == rows["_section_of"], "left").drop("_section_of")
