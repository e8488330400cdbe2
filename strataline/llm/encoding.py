"""Encoding of a corpus with a public byte-level BPE tokenizer, by recursive queries.

In each partition the distinct pre-tokens of a batch become token-position rows of a table. A recursive DuckDB
query joins neighbouring tokens with the merge table and contracts, in each word, the minimum-rank pair from
the left, until no pair of any word is in the table; an ordered aggregation gives the ids. Another one decodes: ids
join the vocabulary, and their bytes are put together in order.

Two exact reductions come first. A text is cut at single spaces, where no pre-token can cross, so that
pre-tokenisation runs once for each distinct piece. And a word is cut between two bytes that stand side by side
in no token of the vocabulary, since no merge can cross there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Folder of the tokenizer files; a parameter of every function here.
TOKENIZERS = "/opt/tokenizers"
#: Pre-tokens of this kind of tokenizer (the published pattern).
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: About the most token-position rows that a query begins with, unless one word has more.
ROWS = 500_000
#: Entries of a worker's memo of words; beyond it words are encoded anew. The results are the same.
MEMO = 400_000

# Equal pairs of one word are contracted together, from the left, without overlap.
_ROWS = """
with recursive step(it, word, pos, id) as (
  select 0, word, pos, id from tokens
  union all
  select it + 1, word, pos, case when hit then made else id end
  from (
    select *, lag(hit, 1, false) over (partition by word order by pos) as gone
    from (
      select it, word, pos, id, made,
        coalesce(rank = least_rank, false)
          and row_number() over (partition by word, rank = least_rank, nth - hits order by nth) % 2 = 1 as hit
      from (
        select *, sum((rank = least_rank)::int) over (partition by word order by pos) as hits, row_number() over (partition by word order by pos) as nth
        from (
          select p.*, m.made, m.rank, min(m.rank) over (partition by word) as least_rank
          from (select *, id::bigint * 65536 + lead(id) over (partition by word order by pos) as pair from step) p
          left join merges m using (pair)
        ) where least_rank is not null
      )
    )
  ) where not gone
), last as (select word, max(it) as it from step group by word)
select word, list(id order by pos) as ids from step join last using (word, it) group by word order by word
"""
_DECODE = "select item, string_agg(bytes, '' order by pos) as bytes from ids join vocabulary using (id) group by item"


def _letters() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """A tokenizer's merge table in DuckDB, and a memo of pieces of text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], _letters()
        if len(vocab) > 65536:
            raise ValueError("the pair keys hold ids under 65536")
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.beside = np.zeros((256, 256), dtype=bool)
        for token, number in vocab.items():
            b = [letters[c] for c in token]
            if len(b) == 1:
                self.byte_ids[b[0]] = number
            self.beside[b[:-1], b[1:]] = True
        spelled = pa.table({"id": pa.array(vocab.values(), pa.int32()), "bytes": ["".join(f"{letters[c]:02x}" for c in token) for token in vocab]})
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = pa.table(
            {
                "pair": pa.array([vocab[a] * 65536 + vocab[b] for a, b in pairs], pa.int64()),
                "rank": pa.array(range(len(pairs)), pa.int32()),
                "made": pa.array([vocab[a + b] for a, b in pairs], pa.int32()),
            }
        )
        # nothing may spill to a folder of the machine
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        for name, rows in (("merges", merges), ("vocabulary", spelled)):
            self.con.register("given", rows)
            self.con.execute(f"create table {name} as select * from given")
            self.con.unregister("given")
        self.pretoken = regex.compile(PRETOKEN)
        self.piece = regex.compile(r"(?<=\S)(?= \S)")
        self.ragged = regex.compile(r" \s|\s ")
        self.pieces: dict[str, list[int]] = {}

    def contract(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, by the recursive query."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        begins = np.repeat(np.cumsum(lengths) - lengths, lengths)
        rows = {
            "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "pos": (np.arange(len(data)) - begins).astype(np.int32),
            "id": self.byte_ids[data],
        }
        self.con.register("tokens", pa.table(rows))
        out = self.con.sql(_ROWS).to_arrow_table()
        self.con.unregister("tokens")
        return out["ids"].to_pylist()

    def _parts(self, word: bytes) -> list[bytes]:
        if len(word) < 2:
            return [word] if word else []
        b = np.frombuffer(word, dtype=np.uint8)
        cuts = np.flatnonzero(~self.beside[b[:-1], b[1:]]) + 1
        ends = [0, *cuts.tolist(), len(word)]
        return [word[i:j] for i, j in zip(ends, ends[1:])]

    def split(self, text: str) -> list[str]:
        """Pieces of a text that no pre-token crosses."""
        if self.ragged.search(text):
            return self.piece.split(text)
        first, *rest = text.split(" ")
        pieces = [" " + p for p in rest]
        return [first, *pieces] if first else pieces

    def learn(self, pieces: set[str]) -> None:
        """Encodes the pieces that the memo lacks."""
        if len(self.pieces) > MEMO:
            self.pieces.clear()
        new = [p for p in pieces if p not in self.pieces]
        if not new:
            return
        words = {p: self.pretoken.findall(p) for p in new}
        parts = {w: self._parts(w.encode("utf-8", "surrogatepass")) for w in {w for ws in words.values() for w in ws}}
        distinct = sorted({x for xs in parts.values() for x in xs})
        known: dict[bytes, list[int]] = {}
        some, size = [], 0
        for x in distinct:  # a bounded number of rows in a query, whatever the texts
            some.append(x)
            size += len(x)
            if size > ROWS:
                known |= zip(some, self.contract(some))
                some, size = [], 0
        known |= zip(some, self.contract(some))
        for p in new:
            self.pieces[p] = [i for w in words[p] for x in parts[w] for i in known[x]]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.split(t) if t else [] for t in texts]
        if len(self.pieces) > MEMO:
            self.pieces.clear()
        self.learn({p for s in split for p in s})
        known, out = self.pieces, []
        for s in split:
            ids: list[int] = []
            for p in s:
                ids += known[p]
            out.append(ids)
        return out


    def decode(self, lists: list[list[int] | None]) -> list[str]:
        """The text of each list of ids; no list and an empty one give an empty text. Ids that the vocabulary lacks, and
        bytes that are no UTF-8 (U+FFFD), can't come from ``encode``."""
        sizes = [0 if x is None else len(x) for x in lists]
        flat = np.concatenate([np.asarray(x, dtype=np.int32) for x, n in zip(lists, sizes) if n]) if any(sizes) else np.zeros(0, dtype=np.int32)
        rows = {"item": np.repeat(np.arange(len(lists), dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int64), "id": flat}
        self.con.register("ids", pa.table(rows))
        found = self.con.sql(_DECODE).to_arrow_table()
        self.con.unregister("ids")
        out = [""] * len(lists)
        for n, spelled in zip(found["item"].to_pylist(), found["bytes"].to_pylist()):
            out[n] = bytes.fromhex(spelled).decode("utf-8", "replace")
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS, batch: int = 2000) -> DataFrame:
    """(key, ids): the ids of each row's text without special tokens, one row for every row of ``df``.

    Null and empty texts get an empty list. Strings that look like special tokens are ordinary text. No shuffle;
    a task holds one Arrow batch of texts and the worker's memo.
    """
    path = f"{folder}/{name}.json"
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                ids = enc.encode([t if isinstance(t, str) else None for t in part[text]])
                yield pd.DataFrame({key: part[key].to_numpy(), "ids": pd.Series([np.asarray(x, dtype=np.int32) for x in ids], dtype=object)})

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, ids array<int>")


def decode_texts(df: DataFrame, key: str = "doc_id", ids: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS, batch: int = 2000) -> DataFrame:
    """(key, text): the text of each row's ids, one row for every row of ``df``; null and empty lists give an empty text.
    No shuffle."""
    path = f"{folder}/{name}.json"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                yield pd.DataFrame({key: part[key].to_numpy(), "text": enc.decode(part[ids].tolist())})

    return df.select(key, ids).mapInPandas(run, f"`{key}` {dict(df.dtypes)[key]}, text string")
