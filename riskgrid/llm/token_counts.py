"""Exact token counts of every prefix of every text, by prefix dynamic programming.

For byte-pair encoding, the encoding of a prefix ends in the one vocabulary token t that is a
suffix of the prefix and stays apart from the last token of the encoding of what lies before t.
So ``count[i] = count[i - len(t)] + 1``: one pass over a piece counts all its prefixes. The
result is a table of the changes of the count at each code point, a byte each (two bytes in a text
with a change beyond a signed byte: ``width``). ``answers`` reads it to tell how long a truncated text
is, and where a token budget ends, without encoding again.

Pieces are cut by the vocabulary's pattern, as the library cuts them; special strings are one
token. Prefixes end at code points. Texts stay whole, very long ones too; each distinct piece is worked
out once per worker, in tables of bounded bytes.

An empty table gives an empty one. Null and empty texts have 0 bytes, 0 tokens and no changes. Rows are treated one by one, so
repeated rows, ties and null ids just pass through. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import arrow_map

#: The pattern of byte-level vocabularies, with Unicode's white space spelled out. Letters come
#: first, which changes nothing: no other branch can begin with one, or with a space before one.
WS = r"\t-\r\x20\x85\xA0  -     　"
PIECES = r" ?{L}+| ?{N}+|'(?:s|t|re|ve|m|ll|d)| ?[^{W}{l}{n}]+|[{W}]+(?![^{W}])|[{W}]+"
#: Letters and numbers below U+0100.
LATIN = {"L": "[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]", "N": "[0-9\xb2\xb3\xb9\xbc-\xbe]",
         "l": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "n": "0-9\xb2\xb3\xb9\xbc-\xbe", "W": WS}
#: Bytes of pieces, and of pairs of tokens, kept by a worker at most; then the table starts anew.
PIECE_BYTES, PAIR_BYTES = 64 << 20, 96 << 20
#: Bytes that an entry takes beside its own characters: objects and its place in the table.
PIECE_ENTRY, PAIR_ENTRY = 200, 250
LIMIT = 512


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter(dict):
    """piece -> the changes of its token count at each code point (as bytes, two each)."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        alphabet = byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank, self.split = {}, {}
        for i, (a, b) in enumerate(merges):
            pair = (as_bytes(a), as_bytes(b))
            self.rank[pair] = i
            self.split.setdefault(pair[0] + pair[1], pair)
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        special_set = set(specials)
        vocab = {as_bytes(t) for t in spec["model"]["vocab"] if t not in special_set and all(c in alphabet for c in t)}
        # Beginnings of tokens as numbers: ``after[256 * number + byte]`` is the next one (0: nothing yet), ``tokens`` names the whole ones.
        self.after: dict[int, int] = {}
        self.tokens: list[bytes | None] = [None]
        for t in vocab:
            at = 0
            for byte in t:
                at = self.after.setdefault(256 * at + byte, len(self.tokens))
                if at == len(self.tokens):
                    self.tokens.append(None)
            if t:
                self.tokens[at] = t
        self.longest = max(map(len, vocab))
        self.piece_bytes = 0
        self.alone: dict[bytes, bool] = {}
        self.known: dict[int, bool] = {}
        self.edges: dict[tuple, list] = {}
        self.cut = re.compile(PIECES.format(**LATIN))
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.spaces = re.compile(rf"[{WS}]{{2,}}(?=[^{WS}])")
        self.library = Tokenizer.from_file(path)

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one end of a token while it is merged: from a byte up, with the rank that makes each."""
        out = self.edges.get((token, side))
        if out is None:
            pair = self.split.get(token)
            out = self.edges[token, side] = [*self.edge(pair[side], side), (token, self.rank[pair])] if pair else [(token, -1)]
        return out

    def apart(self, left: bytes, right: bytes, limit: int) -> bool:
        """Whether no merge of a rank under ``limit`` joins two tokens that are each merged on their own.

        Merges go by rank, leftmost first. Two parts at the border meet from the later one's making
        until the earlier one is merged away; a pair of a rank within that time would be joined.
        """
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        while True:
            end_a = a[i + 1][1] if i + 1 < len(a) else limit
            end_b = b[j + 1][1] if j + 1 < len(b) else limit
            rank = self.rank.get((a[i][0], b[j][0]))
            if rank is not None and rank < end_a and (rank <= end_b if end_b < limit else rank < limit):
                return False
            if end_a >= limit and end_b >= limit:
                return True
            if end_a <= end_b:
                i += 1
            else:
                j += 1

    def merged(self, token: bytes) -> bool:
        """Whether the merges make ``token`` of its own bytes."""
        known = self.alone.get(token)
        if known is None:
            pair = self.split.get(token)
            known = self.alone[token] = len(token) == 1 or pair is not None and self.merged(pair[0]) and self.merged(pair[1]) and self.apart(*pair, self.rank[pair])
        return known

    def stays(self, before: int, token: int) -> bool:
        """Whether the token of a number behind another (0: at the start) is what the merges make."""
        if len(self.known) * PAIR_ENTRY > PAIR_BYTES:
            self.known.clear()
        left, right = self.tokens[before], self.tokens[token]
        known = self.known[before * len(self.tokens) + token] = self.merged(right) and (left is None or self.apart(left, right, 1 << 60))
        return known

    def counts(self, data: bytes) -> list[int]:
        """Token counts of all byte prefixes of a piece, from left to right."""
        n = len(data)
        count, last = [0] * (n + 1), [0] * (n + 1)
        step, tokens, known, longest, size = self.after.get, self.tokens, self.known.get, self.longest, len(self.tokens)
        for start in range(n):
            before, more, at, end = last[start] * size, count[start] + 1, 0, start
            for byte in data[start:start + longest]:
                at = step(256 * at + byte)
                if at is None:
                    break
                end += 1
                if not last[end] and tokens[at] is not None:
                    fits = known(before + at)
                    if fits if fits is not None else self.stays(last[start], at):
                        last[end], count[end] = at, more
        return count

    def __missing__(self, piece: str) -> bytes:
        self.piece_bytes += PIECE_ENTRY + 6 * len(piece)
        if self.piece_bytes > PIECE_BYTES:
            self.clear()
            self.piece_bytes = PIECE_ENTRY + 6 * len(piece)
        data = piece.encode()
        count = self.counts(data)
        if len(data) == len(piece):
            at = count
        else:
            at, end = [0], 0
            for c in piece:
                end += len(c.encode())
                at.append(count[end])
        if len(piece) == 3 and piece[0] == "'" and piece[1:].isalpha():
            # 're, 've and 'll are cut differently while their second letter is missing.
            at = [0, at[1], at[1] + self.counts(piece[1].encode())[-1], at[3]]
        # No change is larger than the longest token.
        out = self[piece] = array("h", map(sub, at[1:], at)).tobytes()
        return out

    def plain(self, text: str) -> np.ndarray:
        """Changes at each code point of a text without special strings."""
        try:
            text.encode("latin-1")
            pieces = self.cut.findall(text)
        except UnicodeEncodeError:  # letters beyond follow the library's own Unicode tables
            pieces = [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        out = np.frombuffer(b"".join(map(self.__getitem__, pieces)), dtype=np.int16)
        runs = [m.span() for m in self.spaces.finditer(text)]
        if runs:
            # A run of spaces gives its last one to what follows; a prefix that ends there still has it whole.
            out = out.copy()
            total = np.concatenate([[0], np.cumsum(out, dtype=np.int64)])
            for a, b in runs:
                more = int(total[a]) + int(np.frombuffer(self[text[a:b]], dtype=np.int16).sum(dtype=np.int64)) - int(total[b])
                out[b - 1] += more
                out[b] -= more
        return out

    def text(self, text: str) -> np.ndarray:
        """Changes at each code point of a text; special strings count as one token."""
        found = [m.span() for m in self.special.finditer(text)] if self.special else []
        if not found:
            return self.plain(text)
        out, start = [], 0
        for a, b in found:
            # Inside the special string, a prefix is ordinary text; at its end it is one token.
            inside = self.plain(text[start:b - 1])
            before, now = int(inside[:a - start].sum(dtype=np.int64)), int(inside.sum(dtype=np.int64))
            out += [inside, np.array([before + 1 - now], dtype=np.int16)]
            start = b
        return np.concatenate([*out, self.plain(text[start:])])


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  table: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_chars, n_tokens`` and, with ``table``, ``width, changes``: so many bytes, signed, for each code point."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            changes = [count.text(t) for t in texts]
            columns = {
                "doc_id": batch.column(0),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_chars": pa.array(map(len, texts), pa.int64()),
                "n_tokens": pa.array([int(c.sum(dtype=np.int64)) for c in changes], pa.int64())}
            if table:
                small = [narrow(c) for c in changes]
                columns["width"] = pa.array([c.itemsize for c in small], pa.int32())
                columns["changes"] = pa.array([c.tobytes() for c in small], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"doc_id {id_type}, n_bytes long, n_chars long, n_tokens long" + ", width int, changes binary" * table
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, schema)


def narrow(changes: np.ndarray) -> np.ndarray:
    """The changes as signed bytes, if they all fit."""
    fits = not changes.size or -128 <= changes.min() and changes.max() <= 127
    return changes.astype(np.int8) if fits else changes


def _read(changes: bytes, width: int) -> np.ndarray:
    return np.frombuffer(changes, dtype=np.int8 if width == 1 else np.int16)


def tokens_at(changes: bytes, n_chars: int, width: int = 1) -> int:
    """Token count of the first ``n_chars`` code points."""
    return int(_read(changes, width)[:n_chars].sum(dtype=np.int64))


def longest_within(changes: bytes, budget: int, width: int = 1) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.concatenate([[0], np.cumsum(_read(changes, width), dtype=np.int64)]) <= budget)
    return int(fits[-1]) if fits.size else 0


def answers(table: DataFrame, budgets: tuple[int, ...] = (), lengths: tuple[int, ...] = ()) -> DataFrame:
    """``table`` (of ``prefix_counts``) with the answers in place of ``width, changes``, read from the table alone.

    ``chars_within_<b>``: code points of the longest prefix of at most b tokens; ``tokens_of_<c>``: tokens of the
    first c code points (of all, if fewer).
    """
    kept = [c for c in table.columns if c not in ("width", "changes")]
    names = [f"chars_within_{b}" for b in budgets] + [f"tokens_of_{c}" for c in lengths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[] for _ in names]
            for width, changes in zip(batch.column("width").to_pylist(), batch.column("changes")):
                data = changes.as_py()
                found = [longest_within(data, b, width) for b in budgets] + [tokens_at(data, c, width) for c in lengths]
                for column, x in zip(out, found):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(x, pa.int64()) for x in out], names=kept + names)

    fields = [f"`{c}` {table.schema[c].dataType.simpleString()}" for c in kept] + [f"{n} long" for n in names]
    return arrow_map(table, run, ", ".join(fields))


def over_limit(limit: int = LIMIT) -> Column:
    return (F.col("n_tokens") > limit).alias("over_limit")
