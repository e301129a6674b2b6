"""BPE encoding and decoding: chunks that several texts share are encoded once, joins are re-encoded until they agree."""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table
from .gear import chunks

#: Chunk sizes in bytes.
LEAST, AVERAGE, MOST = 512, 2048, 16384
#: Words that a worker's cache holds.
CACHE_WORDS = 150_000
#: Pre-tokens that it holds, slots of the table in which a pre-token is marked when it is first met, and characters of text that are cut into pre-tokens at once.
CACHE_PARTS, MARKS, AT_ONCE = 120_000, 1 << 21, 1 << 18


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: visible Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    for k, b in enumerate(x for x in range(256) if x not in set(shown)):
        out[chr(256 + k)] = b
    return out


@functools.cache
def _parts() -> re.Pattern:
    """The pattern of byte-level pre-tokens, with letters and numbers up to U+FFFF spelled as ranges."""
    runs: dict[str, list[list[int]]] = {"L": [], "N": []}
    for k in range(1 << 16):
        mine = runs.get(unicodedata.category(chr(k))[0])
        if mine and mine[-1][1] == k - 1:
            mine[-1][1] = k
        elif mine is not None:
            mine.append([k, k])
    letter, number = ("".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in r) for r in runs.values())
    return re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+")


class Encoder:
    """A byte-level tokenizer of the tokenizers library, whose work on repeated words is kept.

    A text's ids are those of its pre-tokens one after the other. Where the tokenizer cuts by the
    pattern of byte-level pre-tokens and by nothing else, texts are cut by it here, and the ids of
    repeated pre-tokens kept. Other tokenizers' texts, and texts with added tokens or with a
    character that the library puts into another class than this pattern does (asked once a
    character), are cut at spaces: a space between two visible characters always begins a
    pre-token. Of these, texts with other spacing are given to the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cuts_parts = self._refuse_unless_byte_level(path)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        added = self.tok.get_added_tokens_decoder()
        byte_of = _byte_of()
        self.bytes_of: list[bytes] = []
        for i in range(size):
            if i in added:
                self.bytes_of.append(added[i].content.encode())
            else:
                token = self.tok.id_to_token(i) or ""
                self.bytes_of.append(bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode())
        self.size_of = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.cache: dict[str, bytes | None] = {}
        self.heads: dict[str, bytes | None] = {}
        self.plain: dict[str, bool] = {}
        self.added = [x.content for x in added.values()]
        self.parts: dict[str, bytes] = {}
        self.marks = bytearray(MARKS)
        self.alike: dict[str, bool] = {}

    def _refuse_unless_byte_level(self, path: str) -> bool:
        """What is cut here, at single spaces between visible characters, must be cut by the tokenizer too, and its tokens must be bytes. True if it cuts by the byte-level pattern and by nothing else."""
        import json

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        sub = parts.get("pre_tokenizer") or {}
        kinds = {x.get("type") for x in sub.get("pretokenizers", [sub])}
        if "ByteLevel" not in kinds or parts.get("normalizer") or (parts.get("model") or {}).get("type") != "BPE":
            raise ValueError(f"{path} is not a byte-level BPE without a normaliser")
        probe = "Ab c1 2d ,e f. g'h é ñ"
        want = [k for k in range(1, len(probe) - 1) if probe[k] == " " and self._plain_space(probe, k)]
        begins = {a for _, (a, _) in self.tok.pre_tokenizer.pre_tokenize_str(probe)}
        if not begins.issuperset(want):
            raise ValueError(f"the pre-tokenizer of {path} does not begin a pre-token at each space between visible characters")
        return sub.get("type") == "ByteLevel" and sub.get("use_regex", True) and not sub.get("add_prefix_space", True)

    @staticmethod
    def _plain_space(text: str, k: int) -> bool:
        return not text[k - 1].isspace() and not text[k + 1].isspace()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _visible(self, c: str) -> bool:
        ok = self.plain.get(c)
        if ok is None:
            ok = self.plain[c] = unicodedata.category(c)[0] in "LMNPS" and not c.isspace()
        return ok

    def _alike(self, c: str) -> bool:
        """Whether the tokenizer has a character in the class in which the pattern has it: between two of that class it begins no pre-token, and of two white ones each is one before a letter."""
        ok = self.alike.get(c)
        if ok is None:
            kind = unicodedata.category(c)[0]
            if c.isspace():
                probe, want = f"a{c}{c}a", ["a", c, c + "a"] if c == " " else ["a", c, c, "a"]
            elif kind in "LN":
                probe = {"L": "a", "N": "1"}[kind] + c + {"L": "a", "N": "1"}[kind]
                want = [probe] if c < "\U00010000" else []
            else:
                probe = f".{c}."
                want = [probe]
            ok = self.alike[c] = [probe[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(probe)] == want
        return ok

    def _spaced(self, words: list[str]) -> list[bytes]:
        """The ids of words that begin with a space: many at a time as one text, whose ids are then cut at the words' ends."""
        out = []
        for k in range(0, len(words), 1000):
            part = words[k : k + 1000]
            ids = np.array(self.tok.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum([len(w.encode()) for w in part])
            at = np.cumsum(self.size_of[ids])
            last = np.searchsorted(at, ends) + 1
            if len(ids) and at[-1] == ends[-1] and (at[last - 1] == ends).all():
                raw, a = ids.tobytes(), 0
                for b in (last * 4).tolist():
                    out.append(raw[a:b])
                    a = b
            else:
                out += self._ids(part)
        return out

    def _learn(self, words: list[str]) -> None:
        """Encode words that follow a space."""
        good = []
        for w in words:
            if w and self._visible(w[0]) and self._visible(w[-1]):
                good.append(w)
            else:
                self.cache[w] = None
        self.cache |= zip(good, self._spaced([" " + w for w in good]), strict=True)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.cuts_parts:
            return self._by_words(texts)
        odd = {c for t in texts for c in set(t).difference(self.alike) if not self._alike(c)} | {c for c, ok in self.alike.items() if not ok}
        left = {k for k, t in enumerate(texts) if (odd and not odd.isdisjoint(t)) or any(a in t for a in self.added)}
        by_parts = self._by_parts(t for k, t in enumerate(texts) if k not in left)
        by_words = iter(self._by_words([texts[k] for k in sorted(left)]) if left else [])
        return [next(by_words if k in left else by_parts) for k in range(len(texts))]

    def _by_parts(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of texts by their pre-tokens, some texts at once."""
        cut, ends, size, find = [], [], 0, _parts().findall
        for t in texts:
            cut += find(t)
            ends.append(len(cut))
            size += len(t)
            if size >= AT_ONCE:
                ids = self._ids_of(cut)
                yield from (b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False))
                cut, ends, size = [], [], 0
        ids = self._ids_of(cut)
        yield from (b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False))

    def _ids_of(self, cut: list[str]) -> list[bytes]:
        """The ids of pre-tokens. The first are kept when they are met, later ones from the second call on that misses them, while there is room; all are given up when a third of a call's have to be encoded."""
        ids = list(map(self.parts.get, cut))
        missed = [k for k, x in enumerate(ids) if x is None]
        new = list({cut[k] for k in missed})
        if len(self.parts) + len(new) > CACHE_PARTS and len(new) * 3 > len(cut):
            self.parts.clear()
            self.marks = bytearray(MARKS)
        # A space and what follows it begin a pre-token wherever they stand after something visible; white runs are left out.
        spaced = [p for p in new if p[0] == " " and not p.isspace()]
        bare = [p for p in new if p[0] != " " or p.isspace()]
        got = dict(zip(spaced, self._spaced(spaced), strict=True)) | dict(zip(bare, self._ids(bare), strict=True))
        for k in missed:
            ids[k] = got[cut[k]]
        for p in new:
            if len(self.parts) >= CACHE_PARTS:
                break
            mark = hash(p) % MARKS
            if self.marks[mark] or len(self.parts) * 3 < CACHE_PARTS:
                self.parts[p] = got[p]
            self.marks[mark] = 1
        return ids

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") for t in texts]
        heads = [s.pop(0) for s in split]
        need = set().union(*split).difference(self.cache)
        if len(self.cache) + len(need) > CACHE_WORDS and len(need) * 3 > sum(map(len, split)):
            self.cache.clear()
            need = set().union(*split)
        held = len(self.cache)
        self._learn(list(need))
        new = [h for h in dict.fromkeys(heads) if h not in self.heads]
        if len(self.heads) > CACHE_WORDS // 10:
            self.heads.clear()
            new = list(dict.fromkeys(heads))
        self.heads |= dict(zip(new, self._ids(new), strict=True))
        get, out, whole = self.cache.__getitem__, [], []
        for k, (head, parts) in enumerate(zip(heads, split, strict=True)):
            try:
                if parts and not (head and self._visible(head[-1])):
                    raise TypeError
                out.append(self.heads[head] + b"".join(map(get, parts)))
            except TypeError:  # a part that isn't free-standing
                out.append(b"")
                whole.append(k)
        for k, ids in zip(whole, self._ids([texts[k] for k in whole]) if whole else [], strict=True):
            out[k] = ids
        if len(self.cache) > CACHE_WORDS and held:
            for w in need:
                del self.cache[w]
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _safe(data: np.ndarray) -> np.ndarray:
    """Offsets of single spaces between visible ASCII characters; a pre-token begins at each."""
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    seen = (data > 0x20) & (data < 0x7F)
    return np.flatnonzero((data[1:-1] == 0x20) & seen[:-2] & seen[2:]) + 1


def assemble(enc: Encoder, text: str, pieces: list[dict]) -> bytes | None:
    """The ids of text, with those of its pieces (start, n, ids) as given, or None if no piece could be used.

    A piece's ids are kept from its first to its last offset at which a pre-token begins in the
    text and a token begins in the piece; what lies between two kept runs, the join, is encoded
    anew. A run whose token ends don't agree with those offsets is given up and encoded with the
    join around it, so that what is returned always agrees with encoding the whole text.
    """
    data = text.encode()
    safe = _safe(np.frombuffer(data, dtype=np.uint8))
    kept: list[tuple[int, int, bytes]] = []
    for p in sorted(pieces, key=lambda p: p["start"]):
        s, e = p["start"], p["start"] + p["n"]
        a = 0 if s == 0 else safe[k] if (k := np.searchsorted(safe, s)) < len(safe) else e
        z = e if e == len(data) else safe[k] if (k := np.searchsorted(safe, e, side="right") - 1) >= 0 else s
        if a >= z:
            continue
        ends = np.cumsum(enc.size_of[np.frombuffer(p["ids"], dtype="<u4")])
        first = 0 if a == s else int(np.searchsorted(ends, a - s)) + 1
        last = int(np.searchsorted(ends, z - s)) + 1
        if (first and ends[first - 1] != a - s) or last > len(ends) or ends[last - 1] != z - s:
            continue
        kept.append((int(a), int(z), p["ids"][4 * first : 4 * last]))
    if not kept:
        return None
    joins, at = [], 0
    for a, z, _ in kept:
        joins.append(data[at:a].decode())
        at = z
    joins.append(data[at:].decode())
    # A join begins with the space of its first word; a leading space is free-standing there, so it may be encoded on its own.
    new = iter(enc._ids([j for j in joins if j]))
    out = []
    for k, j in enumerate(joins):
        if j:
            out.append(next(new))
        if k < len(kept):
            out.append(kept[k][2])
    return b"".join(out)


_CHUNK = "key binary, start int, n int, digest binary"


def encode_texts(rows: DataFrame, tokenizer: str, digests: bool = False, with_ids: bool = False) -> DataFrame:
    """rows(key binary, text string), equal keys for equal texts, to distinct (key, ids binary, text): ids as little-endian unsigned 32-bit integers.

    Chunk digests come from one pass without text in a shuffle. One exchange deals the distinct
    texts out by key and is read twice: for the chunks that occur more than once, each encoded in
    its first text, and for all texts, with the shared chunks' ids given. Only digests and the ids
    of shared chunks move besides. With digests, the ids are decoded again in the same task and
    (key, n_tokens, ids_sha256, decoded_sha256, and ids if asked for) returned: a second Python stage would hold a second
    tokenizer beside the first.
    """
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows = [(k, *c) for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for c in chunks(t.encode(), least=LEAST, average=AVERAGE, most=MOST)]
                cols = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["key", "start", "n", "digest"])

    found = keep(rows.mapInArrow(cut, _CHUNK).distinct(), "chunks")
    shared = found.groupBy("digest").agg(F.count("*").alias("c"), F.min(F.struct("key", "start", "n")).alias("first")).where("c > 1")

    def encode_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            digests, parts = [], []
            for text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = text.encode()
                for w in wanted:
                    digests.append(w["digest"])
                    parts.append(data[w["start"] : w["start"] + w["n"]].decode())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(enc.encode(parts), pa.binary())], names=["digest", "ids"])

    firsts = shared.select(F.col("first.key").alias("key"), F.col("first.start").alias("start"), F.col("first.n").alias("n"), "digest").groupBy("key").agg(F.collect_list(F.struct("start", "n", "digest")).alias("wanted"))
    once = texts.join(firsts, "key").select("text", "wanted").mapInArrow(encode_shared, "digest binary, ids binary")
    given = found.join(once, "digest").groupBy("key").agg(F.collect_list(F.struct("start", "n", "ids")).alias("pieces"))

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts, pieces = b.column(1).to_pylist(), b.column(2).to_pylist()
                out = [assemble(enc, t, p) if p else None for t, p in zip(texts, pieces, strict=True)]
                rest = [k for k, ids in enumerate(out) if ids is None]
                for k, ids in zip(rest, enc.encode([texts[k] for k in rest]) if rest else [], strict=True):
                    out[k] = ids
                if digests:
                    cols = [b.column(0), pa.array([len(x) // 4 for x in out], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in out]), pa.array([hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in out])]
                    yield pa.RecordBatch.from_arrays(cols + [pa.array(out, pa.binary())] * with_ids, names=["key", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)
                else:
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["key", "ids"])

    schema = "key binary, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids if digests else "key binary, ids binary"
    return texts.join(given, "key", "left").select("key", "text", "pieces").mapInArrow(encode_all, schema)


def encode_documents(docs: DataFrame, *, text: str = "text", tokenizer: str | None = None, digests: bool = False, with_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """(docs with __key, the digest of their text; the distinct texts by that key, encoded).

    Null texts count as empty and have no ids. Equal texts share a key, so copies of any number are
    encoded once; they are combined on the map side before the exchange. Other columns of docs are
    kept; one named __key gives way. Rows that repeat are kept and have one text between them, null ids are
    like others; an empty table gives two empty ones.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.withColumn("__key", F.coalesce(F.unhex(F.md5(F.encode(whole, "UTF-8"))), F.lit(b"")))
    return keyed, encode_texts(keyed.select(F.col("__key").alias("key"), whole.alias("text")), tokenizer or default_tokenizer(), digests, with_ids)


def encoded_digests(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """docs(doc_id, text) to doc_id, n_tokens, ids_sha256 and decoded_sha256, one row a row; the decoded text is made from the ids. With with_ids also ids, as little-endian unsigned 32-bit integers. An empty table gives an empty result; repeated rows and null ids keep a row each."""
    keyed, encoded = encode_documents(docs.select("doc_id", "text"), tokenizer=tokenizer, digests=True, with_ids=with_ids)
    return keyed.select("doc_id", F.col("__key").alias("key")).join(encoded, "key").drop("key")


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: token count and digests of its ids and of the text decoded from them."""
    return encoded_digests(table(spark, sf_dir, "documents"))
