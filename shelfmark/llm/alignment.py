"""Token alignment of two tokenizers by a dangling-suffix transducer.

Method. Both tokenizers cut the same bytes, so at any point one side leads by the bytes that the other
has not covered yet. The transducer's state is the leading side and these bytes, the dangling suffix.
It takes the next token of the side that lags: the suffix gets shorter, or the lead changes and the
rest of that token dangles. Each such step is one overlapping pair of tokens, a link. When nothing
dangles, a group closes. Transitions are memoised by (side, suffix, next token).

A text is cut at blanks between two characters that are no white space. Neither tokenizer has a token
over such a cut (the first splits before the blank, no piece of the second has its blank mark behind
another character), so nothing dangles there and the run over a text is that over its words one after
the other. A worker keeps each distinct word's groups in a table; when it is full, the half of it
that was met least often goes.

Counts. Tasks write blocks of some documents: each document's distinct words, the words' links, and in
how many of the block's documents each id pair is linked. Blocks' sums are added up by pair, a pair's
count and its A id's highest count go back once to each block that has the pair, and the block's
documents are added up there. A pair that every document has costs one row for each block, not one
for each document; no task holds the pairs of all.

Cases. Null and empty texts, and those whose tokens do not spell the text again (a text with U+2581,
for one), have no tokens: zeros and ''. Texts of any length are taken whole; one without blanks is one
word. Repeated rows are documents of their own and count as such, null ids too. An empty table gives
no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import give_back, slices, table
from shelfmark.session import small_batches, stash

#: A block closes at so many distinct words of documents, counted by document.
BLOCK_ENTRIES = 500_000
#: Characters of words that a worker's table holds, and its words.
TABLE_CHARS, TABLE_WORDS = 16_000_000, 300_000
#: Words that are sent to the tokenizers as one text, and characters of a word that is sent alone.
TOGETHER, LONG = 2000, 1000
#: Bytes of text that are worked on at a time.
SLICE = 2_000_000
#: States of the transducer that are remembered.
MEMO_STATES = 200_000
#: A blank that both tokenizers cut at: with characters on both sides that are no white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than blanks and line ends; texts that have it are cut by the pattern.
RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary shows bytes: printable ones as they are, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


#: How a byte-level vocabulary's text is cut before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Pair:
    """The two tokenizers, and the bytes of each of their ids.

    A byte-level vocabulary whose ids ascend with its merges is what rank files hold, and the library for
    those finds the same ids in a quarter of the time; tests compare the two. Others go to their own.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        size_a = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes: tuple[list[bytes], list[bytes]] = ([b""] * size_a, [])
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes[0][i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes[1].append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.by_rank = self._by_rank(path_a)

    def _by_rank(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut_by = file["model"], file["pre_tokenizer"] or {}
        if model["type"] != "BPE" or file["normalizer"] or model.get("ignore_merges") or cut_by.get("type") != "ByteLevel" or cut_by["add_prefix_space"] or not cut_by["use_regex"]:
            return None
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or len(merged) + 256 != len(model["vocab"]):
            return None
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={self.bytes[0][i]: i for i in model["vocab"].values()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        if self.by_rank:
            a = [self.by_rank.encode_ordinary(" " + t) for t in texts]
        else:
            a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return list(zip(a, self.b.encode(texts, num_threads=1)))


class Transducer:
    """State 0: nothing dangles. Other states: the side that leads (0 or 1) and its bytes that the other has not covered."""

    def __init__(self, token_bytes: tuple[list[bytes], list[bytes]]):
        self.bytes = token_bytes
        self.width = len(token_bytes[1])
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple[int, bytes], int] = {(1, b""): 0}
        self.states: list[tuple[int, bytes]] = [(1, b"")]
        #: The side whose token comes next, and the next state by that token; -1 where the bytes differ.
        self.lags: list[int] = [0]
        self.moves: list[dict[int, int]] = [{}]

    def _step(self, state: int, token: int) -> int:
        """The state after a token that the memo does not have."""
        lead, suffix = self.states[state]
        own = self.bytes[1 - lead][token]
        if not own:
            to = None  # a token without bytes spells nothing
        elif suffix.startswith(own):
            to = (lead, suffix[len(own) :])
        elif own.startswith(suffix):
            to = (1 - lead, own[len(suffix) :])
        else:
            to = None
        number = -1
        if to:
            to = to if to[1] else (1, b"")
            number = self.numbers.setdefault(to, len(self.states))
            if number == len(self.states):
                self.states.append(to)
                self.lags.append(1 - to[0])
                self.moves.append({})
        self.moves[state][token] = number
        return number

    def run(self, a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]] | None:
        """Tokens of A and of B at each group's end, and links as ``a * width + b``; None if the sides spell other bytes."""
        if len(self.states) > MEMO_STATES:
            self.forget()
        moves, lags, width = self.moves, self.lags, self.width
        opening, step = moves[0], self._step
        ends_a, ends_b, links = [], [], []
        i = j = 0
        try:
            while i < len(a):
                x = a[i]
                i += 1
                state = opening.get(x)
                if state is None:
                    state = step(0, x)
                if state < 0:
                    return None
                while state:
                    if lags[state]:
                        token = y = b[j]
                        j += 1
                    else:
                        token = x = a[i]
                        i += 1
                    links.append(x * width + y)
                    to = moves[state].get(token)
                    state = step(state, token) if to is None else to
                    if state < 0:
                        return None
                ends_a.append(i)
                ends_b.append(j)
        except IndexError:  # one side ends while the other dangles
            return None
        return (ends_a, ends_b, links) if j == len(b) else None


class Words:
    """A worker's table: the groups, links and numbers of tokens of each distinct word."""

    def __init__(self, path_a: str, path_b: str, keep: int = TABLE_WORDS):
        self.pair, self.keep = Pair(path_a, path_b), keep
        self.transducer = Transducer(self.pair.bytes)
        self.sizes_a = np.array([len(x) for x in self.pair.bytes[0]], np.int64)
        self.digits = [str(i) for i in range(max(map(len, self.pair.bytes)))]
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.met = np.zeros(0, np.int64)
        #: Tokens of A and B, groups and links by word; a word that is not spelled again has -1 tokens.
        self._sizes: list[np.ndarray] = [np.zeros((0, 4), np.int64)]
        self._links: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.chars = 0

    def sizes(self) -> np.ndarray:
        if len(self._sizes) > 1:
            self._sizes = [np.concatenate(self._sizes)]
        return self._sizes[0]

    def links(self) -> np.ndarray:
        """Links of all words one after the other."""
        if len(self._links) > 1:
            self._links = [np.concatenate(self._links)]
        return self._links[0]

    def links_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of these words one after the other, and how many each has."""
        n = self.sizes()[:, 3]
        start, size = (np.cumsum(n) - n)[codes], n[codes]
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.links()[at], size

    def full(self) -> bool:
        return self.chars > TABLE_CHARS or len(self.known) > self.keep

    def shed(self) -> None:
        """The half of the words that was met least often goes; the others get new numbers."""
        self.met = np.append(self.met, np.zeros(len(self.known) - len(self.met), np.int64))
        at = np.sort(np.argsort(self.met, kind="stable")[len(self.met) // 2 :])
        links, _ = self.links_of(at)
        words = list(self.known)
        self.known = {words[i]: k for k, i in enumerate(at.tolist())}
        self.groups = [self.groups[i] for i in at.tolist()]
        self._sizes, self._links, self.met = [self.sizes()[at]], [links], self.met[at] // 2
        self.chars = sum(map(len, self.known))
        if self.chars > TABLE_CHARS // 2:  # a few words of great length
            self.known, self.groups, self.chars, self.met = {}, [], 0, self.met[:0]
            self._sizes, self._links = [self.sizes()[:0]], [links[:0]]

    def _put(self, words: list[str], groups: list[str], sizes: np.ndarray, links: list[int]) -> None:
        self.known.update(zip(words, range(len(self.groups), len(self.groups) + len(words))))
        self.groups += groups
        self.chars += sum(map(len, words))
        self._sizes.append(sizes)
        self._links.append(np.array(links, np.int64))

    def _rendered(self, a: list[int], b: list[int], ends_a: list[int], ends_b: list[int]) -> list[str]:
        digits, out, i, j = self.digits, [], 0, 0
        for x, y in zip(ends_a, ends_b):
            if x - i == 1 and y - j == 1:
                out.append(digits[a[i]] + "|" + digits[b[j]])
            else:
                out.append(",".join([digits[t] for t in a[i:x]]) + "|" + ",".join([digits[t] for t in b[j:y]]))
            i, j = x, y
        return out

    def _alone(self, words: list[str]) -> None:
        for word, (a, b) in zip(words, self.pair.encode(words)):
            found = self.transducer.run(a, b)
            if found is None:
                self._put([word], [""], np.array([[-1, 0, 0, 0]]), [])
            else:
                self._put([word], [";".join(self._rendered(a, b, *found[:2]))], np.array([[len(a), len(b), len(found[0]), len(found[2])]]), found[2])

    def _together(self, words: list[str]) -> bool:
        """Words as one text, in which nothing dangles between two of them; False if that does not hold."""
        ((a, b),) = self.pair.encode([" ".join(words)])
        found = self.transducer.run(a, b)
        if found is None:
            return False
        ends_a, ends_b, links = found
        of_a, of_b = np.array(ends_a), np.array(ends_b)
        group_ends = np.cumsum(self.sizes_a[np.array(a)])[of_a - 1]
        word_ends = np.cumsum([len(w.encode()) + 1 for w in words])
        last = np.searchsorted(group_ends, word_ends)  # a word ends where a group does
        if last[-1] >= len(group_ends) or (group_ends[last] != word_ends).any():
            return False
        n = [np.diff(x, prepend=0) for x in (of_a[last], of_b[last], last + 1)]
        made, at = self._rendered(a, b, ends_a, ends_b), [0, *(last + 1).tolist()]
        self._put(words, [";".join(made[i:j]) for i, j in zip(at, at[1:])], np.stack([*n, n[0] + n[1] - n[2]], 1), links)
        return True

    def learn(self, words: list[str]) -> None:
        plain = {w: None for w in words if w and not w[0].isspace() and not w[-1].isspace() and len(w) < LONG}
        asked = list(plain)
        for i in range(0, len(asked), TOGETHER):
            part = asked[i : i + TOGETHER]
            if not self._together(part):
                self._alone(part)
        if rest := [w for w in words if w not in plain]:
            self._alone(rest)


@cache
def words_of(path_a: str, path_b: str, keep: int) -> Words:
    """One table a worker process, so that tasks after the first find words in it."""
    return Words(path_a, path_b, keep)


def cut(text: str) -> list[str]:
    plain = not (text[0].isspace() or text[-1].isspace() or any(x in text for x in ("  ", " \n", "\n ")) or any(c in text for c in RARE))
    return text.split(" ") if plain else CUT.split(text)


@dataclass
class Block:
    """Documents of one block: their columns, distinct words and how often each; documents by pair."""

    rows: list[tuple] = field(default_factory=list)
    codes: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)
    pairs: list[np.ndarray] = field(default_factory=list)
    docs: list[np.ndarray] = field(default_factory=list)
    entries: int = 0


def _add(block: Block, words: Words, batch: pa.RecordBatch, text_out: bool) -> None:
    """One slice of documents."""
    doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
    found, unknown, new = [], {}, {}
    for d, text in enumerate(texts):
        ws = cut(text) if text else []
        at = list(map(words.known.get, ws))
        if None in at:
            unknown[d] = ws
            new.update((w, None) for w, i in zip(ws, at) if i is None)
        found.append(at)
    if new:
        words.learn(list(new))
        for d, ws in unknown.items():
            found[d] = list(map(words.known.__getitem__, ws))
    groups, sizes = words.groups, words.sizes()
    owners, uniq = [], []
    for d, at in enumerate(found):
        code, n = np.unique(np.array(at, np.int64), return_counts=True)
        size = sizes[code]
        if not len(code) or size[:, 0].min() < 0:
            block.rows.append((doc_ids[d], 0, 0, 0, 0, ""))
            code, n = code[:0], n[:0]
        else:
            made = ";".join(map(groups.__getitem__, at))
            block.rows.append((doc_ids[d], *(size * n[:, None]).sum(0).tolist(), made if text_out else hashlib.sha256(made.encode()).hexdigest()))
        block.codes.append(code)
        block.times.append(n)
        block.entries += len(code)
        owners.append(np.full(len(code), d))
        uniq.append(code)
    owner, code = np.concatenate(owners), np.concatenate(uniq)
    words.met = np.append(words.met, np.zeros(len(groups) - len(words.met), np.int64))
    words.met += np.bincount(code, minlength=len(groups))
    if not len(code):
        return
    # distinct pairs of each document, then documents by pair; a slice has less than 2**24 documents
    links, n_links = words.links_of(code)
    held = np.sort(links << 24 | np.repeat(owner, n_links))
    held = held[np.append(True, held[1:] != held[:-1])] >> 24
    first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
    block.pairs.append(held[first])
    block.docs.append(np.diff(np.append(first, len(held))))


def packed(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending word numbers as differences, then how often; all low bytes come first, then the next, which compress well."""
    values = np.concatenate([np.diff(codes, prepend=0), times]).astype("<u4")
    return values.view("u1").reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    values = np.ascontiguousarray(np.frombuffer(data, "u1").reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    n = len(values) // 2
    return np.cumsum(values[:n]), values[n:]


#: Rows of a block: documents (kind 0), words with their links (1), pairs with their documents (2).
_STORED = "block long, kind int, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, held binary, xs array<bigint>, ys array<bigint>"
_NAMES = ["block", "kind", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "held", "xs", "ys"]
_PIECE = 20_000


def _closed(block: Block, words: Words, number: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    types = [pa.int64(), pa.int32(), id_type, *[pa.int64()] * 4, pa.string(), pa.binary(), longs, longs]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES)

    all_codes = np.unique(np.concatenate([*block.codes, np.zeros(0, np.int64)]))
    for i in range(0, len(block.rows), 500):
        rows = zip(block.rows[i : i + 500], block.codes[i : i + 500], block.times[i : i + 500])
        yield batch([(number, 0, *r, packed(np.searchsorted(all_codes, c), t), None, None) for r, c, t in rows])
    # words' links by word, in pieces of whole words; ys has the number of links of each word
    links, sizes = words.links_of(all_codes)
    edges = np.append(0, np.cumsum(sizes))
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + _PIECE, "right")) - 1)
        yield batch([(number, 1, None, start, None, None, None, None, None, links[edges[start] : edges[stop]], sizes[start:stop])])
        start = stop
    if block.pairs:
        pair, at = np.unique(np.concatenate(block.pairs), return_inverse=True)
        docs = np.bincount(at, np.concatenate(block.docs)).astype(np.int64)
        for i in range(0, len(pair), _PIECE):
            yield batch([(number, 2, None, None, None, None, None, None, None, pair[i : i + _PIECE], docs[i : i + _PIECE])])


@dataclass(frozen=True)
class Aligned:
    """Stored blocks of aligned documents."""

    blocks: DataFrame
    width: int

    def pairs(self) -> DataFrame:
        """``pair, a, b, n_docs``: in how many documents of the corpus each id pair is linked."""
        sums = self._by_block().groupBy("pair").agg(F.sum("n").alias("n_docs"))
        return sums.select("pair", F.expr(f"pair div {self.width}").alias("a"), (F.col("pair") % self.width).alias("b"), "n_docs")

    def _by_block(self) -> DataFrame:
        return self.blocks.filter("kind = 2").select("block", F.explode(F.arrays_zip("xs", "ys")).alias("p")).select("block", F.col("p.xs").alias("pair"), F.col("p.ys").alias("n"))

    def documents(self) -> DataFrame:
        """One row a document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``."""
        counts = self.pairs()
        top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
        known = counts.join(top, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))
        back = self._by_block().select("block", "pair").join(known, "pair").select(F.col("block").alias("of"), "pair", "n_docs", "best")
        rows = self.blocks.filter("kind < 2")
        id_type = dict(rows.dtypes)["doc_id"]
        schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"

        def sums(left: pa.Table, right: pa.Table) -> pa.Table:
            words_of.cache_clear()  # workers live on, and no words are looked up any more
            right = right.sort_by("pair")
            pair, n = right["pair"].to_numpy(), right["n_docs"].to_numpy()
            best = right["best"].to_numpy().astype(np.int64)
            kind = left["kind"].to_numpy()
            pieces = left.filter(pa.array(kind == 1)).sort_by("n_a")
            docs = left.filter(pa.array(kind == 0))
            flat = lambda c: c.combine_chunks().flatten().to_numpy() if len(c) else np.zeros(0, np.int64)
            links, sizes = flat(pieces["xs"]), flat(pieces["ys"])
            at = np.searchsorted(pair, links)
            by_word = [_sums(v[at] if len(links) else links, sizes) for v in (best, n)]
            held = [unpacked(x) for x in docs["held"].to_pylist()]
            out = [pa.array([int(v[code] @ times) for code, times in held], pa.int64()) for v in by_word]
            arrays = [*(docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *out, docs["groups"]]
            return pa.table(arrays, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

        return rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(sums, schema)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over runs of these sizes; a run may be empty."""
    total = np.append(0, np.cumsum(values))
    edges = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return (total[edges[1:]] - total[edges[:-1]]).astype(np.int64)


def align(docs: DataFrame, paths: tuple[str, str] | None = None, text_out: bool = True, keep: int = TABLE_WORDS) -> Aligned:
    """Align ``docs(doc_id, text)``; without ``text_out`` groups are told by the SHA-256 of their text form."""
    path_a, path_b = paths or tokenizer_paths()
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    entries = BLOCK_ENTRIES
    id_name = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block = words_of(path_a, path_b, keep), Block()
        number, id_type = TaskContext.get().partitionId() << 24, pa.int64()
        for batch in chain.from_iterable(slices(b, SLICE) for b in batches):
            id_type = batch.schema.field("doc_id").type
            _add(block, words, batch, text_out)
            if block.entries >= entries or words.full():
                yield from _closed(block, words, number, id_type)
                number, block = number + 1, Block()
                if words.full():
                    words.shed()
        if block.rows:
            yield from _closed(block, words, number, id_type)
        give_back()

    from sentencepiece import SentencePieceProcessor

    width = SentencePieceProcessor(model_file=path_b).get_piece_size()
    return Aligned(stash(rows.mapInArrow(run, _STORED.format(id=id_name)), "aligned"), width)


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(table(spark, sf_dir, "documents"), text_out=False).documents()
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
