"""Two tokenizers on the same texts: where their tokens end together, which tokens overlap, and how often over all texts."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Encoder, _byte_of, default_tokenizer
from .common import Scratch, table

#: UTF-8 bytes of text in one chunk, whose pairs are counted together before anything is shuffled.
CHUNK_BYTES = 16 << 20
#: States that a worker's transducer holds before it begins anew, with a new chunk.
STATES = 300_000
#: Words that a worker's caches hold.
CACHE_WORDS = 200_000


def piece_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A sentencepiece BPE model. by_word: no piece holds a space behind another character, so no merge crosses such a border, and a text's ids are those of its words, each with the spaces before it."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.by_word = not any(p[k] == "▁" != p[k - 1] for p in pieces for k in range(1, len(p)))
        probe = "Ab  c1 éﬁ あx , .  d'e\n f"
        self.by_word = self.by_word and sum((self.sp.encode(w) for w in self._words(probe)), []) == self.sp.encode(probe)

    @staticmethod
    def _words(text: str) -> list[str]:
        """The words of a text, each with all but one of the spaces before it; the one is what the library adds itself."""
        out, gap = [], 0
        for p in text.split(" "):
            if p:
                out.append(" " * gap + p)
                gap = 0
            else:
                gap += 1
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1) if texts else []


class Transducer:
    """Reads the tokens of both sides so that the side that is behind comes next.

    A state is the side that leads and the bytes it is ahead by, along the tokens read since both
    sides last ended together. A step, from a state by the next token, is worked out once and then
    looked up. A step that leaves no bytes closes a group; its name and links are kept with it.
    """

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        if max(len(a_bytes), len(b_bytes)) > 1 << 20:
            raise ValueError("a vocabulary has more than 2^20 ids")
        self.bytes_of = (a_bytes, b_bytes)
        self.step: dict[int, int] = {}
        #: By state, without its last bit, which is 1 if side B is to be read next: the bytes ahead, and the step that led here.
        self.ahead, self.came = [b""], [(0, 0, 0)]
        self.groups: dict[tuple, int] = {}
        self.names: list[str] = []
        self.links: list[np.ndarray] = []
        #: By group: tokens of either side, and bytes.
        self.sizes: list[tuple[int, int]] = []
        self.width: list[int] = []

    def _learn(self, key: int) -> int:
        """The state that key, a state and a token, leads to; -1 - g where it closes group g; raises ValueError where the bytes differ."""
        state, token = key >> 20, key & 0xFFFFF
        side, state = state & 1, state >> 1
        new, ahead = self.bytes_of[side][token], self.ahead[state]
        n = min(len(new), len(ahead))
        if new[:n] != ahead[:n]:
            raise ValueError("the sides differ")
        self.came.append((state, side, token))
        # At the start side A is read and leads; else the side that was behind has caught up, or leads by what is left.
        left = new[n:] or ahead[n:]
        if left:
            self.ahead.append(left)
            out = 2 * len(self.ahead) - 2 + (1 - side if len(new) > n else side)
        else:
            out = -1 - self._close()
            self.came.pop()
        self.step[key] = out
        return out

    def _close(self) -> int:
        tokens: tuple[list[int], list[int]] = ([], [])
        state, side, token = self.came[-1]
        while True:
            tokens[side].append(token)
            if not state:
                break
            state, side, token = self.came[state]
        a, b = tuple(tokens[0][::-1]), tuple(tokens[1][::-1])
        if (a, b) not in self.groups:
            self.groups[a, b] = len(self.names)
            self.names.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
            i = j = at_a = at_b = 0
            pairs = []
            while i < len(a) and j < len(b):
                pairs.append(a[i] << 32 | b[j])
                end_a, end_b = at_a + len(self.bytes_of[0][a[i]]), at_b + len(self.bytes_of[1][b[j]])
                if end_a <= end_b:
                    i, at_a = i + 1, end_a
                if end_b <= end_a:
                    j, at_b = j + 1, end_b
            self.links.append(np.array(pairs, np.int64))
            self.sizes.append((len(a), len(b)))
            self.width.append(sum(len(self.bytes_of[0][i]) for i in a))
        return self.groups[a, b]

    def run(self, a: list[int], b: list[int]) -> list[int] | None:
        """The groups of two token lists in order, or None where their bytes differ."""
        rest, more, get, state, out = iter(b), iter(a), self.step.get, 0, []
        try:
            for token in more:
                key = state << 20 | token
                state = get(key)
                if state is None:
                    state = self._learn(key)
                while state > 0 and state & 1:
                    key = state << 20 | next(rest)
                    state = get(key)
                    if state is None:
                        state = self._learn(key)
                if state < 0:
                    out.append(-1 - state)
                    state = 0
            return None if state or next(rest, None) is not None else out
        except (StopIteration, ValueError):  # side B ends first, or its bytes differ
            return None


#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked(path: str):
    """The same vocabulary as a tiktoken encoding, which is several times faster, where each merge's id is its rank; else None. Its classes of characters are another library's, so only ASCII is given to it."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    ids, byte_of, added = parts["model"]["vocab"], _byte_of(), {x["content"] for x in parts["added_tokens"]}
    made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in parts["model"]["merges"]]
    if parts["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or any(x >= y for x, y in zip(made, made[1:], strict=False)) or not all(c in byte_of for k in ids if k not in added for c in k):
        return None
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={bytes(byte_of[c] for c in k): v for k, v in ids.items() if k not in added}, special_tokens={})


class Aligner:
    """Both tokenizers and the transducer, with the groups of repeated words kept.

    Where single spaces stand between visible characters both sides' tokens end before the space, so
    a text's groups are those of its words, each with its space. Other texts are encoded and run whole.
    """

    def __init__(self, a: str, b: str):
        self.a, self.b = Encoder(a), Pieces(b)
        self.a.tok.encode_special_tokens = True
        self.fast = ranked(a)
        self.forget()

    def forget(self) -> None:
        self.machine = Transducer(self.a.bytes_of, self.b.bytes_of)
        self.cache: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """Side A's ids of a space and each text."""
        if self.fast and all(map(str.isascii, texts)):
            return [self.fast.encode_ordinary(" " + t) for t in texts]
        return [np.frombuffer(x, "<u4").tolist() for x in self.a._ids([" " + t for t in texts])]

    def _run(self, texts: list[str]) -> list[bytes | None]:
        """The groups of a space and each text as 32-bit integers, None where either side doesn't give its bytes back."""
        out: list[bytes | None] = []
        for t, mine, ids in zip(texts, self._ids(texts), self.b.encode(texts), strict=True):
            ok = b"".join(map(self.a.bytes_of.__getitem__, mine)) == (" " + t).encode()
            groups = self.machine.run(mine, ids) if ok else None
            out.append(None if groups is None else np.array(groups, "<i4").tobytes())
        return out

    def _learn(self, words: list[str]) -> None:
        """Many words as one text, whose groups are cut at the words' ends."""
        for k in range(0, len(words), 1000):
            part = words[k : k + 1000]
            (raw,) = self._run([" ".join(part)])
            if raw is None:
                self.cache.update(zip(part, self._run(part), strict=True))
                continue
            width = self.machine.width
            at = np.cumsum([width[g] for g in np.frombuffer(raw, "<i4").tolist()])
            last = np.searchsorted(at, np.cumsum([len(w.encode()) + 1 for w in part])) + 1
            self.cache.update(zip(part, map(raw.__getitem__, map(slice, (4 * np.append(0, last[:-1])).tolist(), (4 * last).tolist())), strict=True))

    def groups(self, texts: list[str]) -> list[bytes | None]:
        split = [t.split(" ") if t and self.b.by_word else [""] for t in texts]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            # Words that are met again come back from the older half, the others go when it is filled anew.
            new = set().union(*split)
            self.older, self.cache = self.cache, {}
        again = new.intersection(self.older)
        self.cache.update(zip(again, map(self.older.__getitem__, again), strict=True))
        new = list(new.difference(again))
        good = [w for w in new if w and "▁" not in w and self.a._visible(w[0]) and self.a._visible(w[-1])]
        self.cache.update(dict.fromkeys(new))
        for ascii_ in (True, False):
            self._learn([w for w in good if w.isascii() == ascii_])
        out: list[bytes | None] = []
        whole = []
        for k, words in enumerate(split):
            try:
                out.append(b"".join(map(self.cache.__getitem__, words)))
            except TypeError:  # a word that doesn't stand for itself
                out.append(None)
                if texts[k]:
                    whole.append(k)
        for k, x in zip(whole, self._run([texts[k] for k in whole]), strict=True):
            out[k] = x
        return out


_aligners: dict[tuple, Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


_SCHEMA = "chunk string, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<int>, pairs array<long>, totals array<long>"
_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))


def _chunk(docs: list[tuple], held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One chunk's rows: its documents with their pairs, numbered within the chunk, and one row of the pairs and their totals."""
    name = uuid.uuid4().hex
    flat = np.concatenate([c for c, _ in held])
    pairs, at = np.unique(flat, return_inverse=True)
    totals = np.bincount(at, np.concatenate([w for _, w in held]), len(pairs)).astype(np.int64)
    ends, at = np.cumsum([len(c) for c, _ in held]), at.astype(np.int32)
    rows = [(name, k, *d, at[e - len(c) : e], w.astype(np.int32), None, None) for k, (d, (c, w), e) in enumerate(zip(docs, held, ends.tolist(), strict=True))]
    rows.append((name, None, None, None, None, None, None, None, None, None, pairs, totals))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=[c.split()[0] for c in _SCHEMA.split(", ")])


def align_tokens(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(one row a document; one row a pair of ids that overlap anywhere: a, b, count, best).

    Side A encodes a space and the text, side B the text, to which it adds the space itself; special
    tokens' strings are plain text. Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum
    and groups_sha256. A pair's count is its number of links over all documents, best says whether
    no pair with the same b has more (ties are all best).

    Null and empty texts, and texts that either side doesn't give back byte for byte, have zeros and
    an empty digest. doc_id is read as a long, null ones stay; repeated rows each have a row and each
    count. An empty table gives empty results. Other columns are ignored.

    Texts are read once, in chunks; a chunk's distinct pairs are counted in its task, so what is
    shuffled is a row a pair and chunk. The counts come back by a join on the pair and are dealt to
    the documents of their chunk, a bounded group. Only the highest count of each id of B is
    broadcast: a row an id of its vocabulary at most.
    """
    a, b = a or default_tokenizer(), b or piece_tokenizer()
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a, b)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        out, held, size = [], [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                part = whole.slice(start, 200)
                texts = part.column(1).to_pylist()
                for key, t, raw in zip(part.column(0).to_pylist(), texts, both.groups(texts), strict=True):
                    size += len(t) + 200
                    if raw is None:
                        out.append((key, 0, 0, 0, 0, ""))
                        held.append(none)
                        continue
                    groups, m = np.frombuffer(raw, "<i4"), both.machine
                    kinds, often = np.unique(groups, return_counts=True)
                    kinds, each = kinds.tolist(), often.tolist()
                    links = [m.links[g] for g in kinds]
                    codes, at = np.unique(np.concatenate(links), return_inverse=True)
                    often = np.repeat(often, [len(x) for x in links])
                    held.append((codes, np.bincount(at, often, len(codes)).astype(np.int64)))
                    n_a, n_b = (sum(n * m.sizes[g][side] for g, n in zip(kinds, each, strict=True)) for side in (0, 1))
                    out.append((key, n_a, n_b, len(groups), int(often.sum()), hashlib.sha256(";".join(map(m.names.__getitem__, groups.tolist())).encode()).hexdigest()))
                if size >= chunk_bytes or len(both.machine.ahead) > STATES:
                    if out:
                        yield _chunk(out, held)
                    out, held, size = [], [], 0
                    if len(both.machine.ahead) > STATES:
                        both.forget()
        if out:
            yield _chunk(out, held)

    scratch = Scratch(docs.sparkSession, "crosstok")
    made = scratch.keep(rows.mapInArrow(run, _SCHEMA))
    each = made.where("pairs IS NOT NULL").select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("pairs", "totals")).alias("at", "p")).select("of", "at", F.col("p.pairs").alias("pair"), F.col("p.totals").alias("total"))
    counts = scratch.keep(each.groupBy("pair").agg(F.sum("total").alias("count")))
    id_b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    top = counts.groupBy(id_b.alias("b")).agg(F.max("count").alias("most"))
    counts = counts.withColumn("b", id_b).join(F.broadcast(top), "b").select("pair", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    back = each.select("of", "at", "pair").join(counts.select("pair", "count", "best"), "pair").select("of", "at", "count", "best")

    def deal(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        ats, times = left.column("at").combine_chunks(), left.column("times").combine_chunks()
        ends = ats.offsets.to_numpy().astype(np.int64)
        flat, w = ats.values.to_numpy(), times.values.to_numpy().astype(np.int64)
        run = lambda x: np.diff(np.append(0, np.cumsum(x))[ends])
        sums = [pa.array(run(w * v[flat])) for v in (best, count)]
        keep = [left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*keep, *sums, left.column("groups_sha256")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    papers = made.where("pairs IS NULL").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times")
    done = papers.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(deal, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return done, counts.select(F.shiftright("pair", 32).alias("a"), "b", "count", "best")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups and links between the two tokenizers."""
    return align_tokens(table(spark, sf_dir, "documents"))[0]
