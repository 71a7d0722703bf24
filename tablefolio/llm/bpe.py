"""Encoding and decoding with a public BPE tokenizer file, exactly as its library does on whole texts.

Two facts keep whole texts cheap and parallel:

* A tokenizer whose pre-tokenizer drops white space treats each unit between ASCII white space on its own, and where its
  normalizer and pattern are the known ones of `word_splitter`, each word in it, in lower case. Units repeat, so a task
  asks the library once per distinct unit it has seen lately; for words of plain characters (`PLAIN`) it asks the
  library's BPE model itself, as the normalizer and the pattern have nothing to do there.
* A longer text is cut in halves again and again until the leaves are short. Leaves are encoded in different tasks;
  then neighbours are joined in the order of the tree. At each join a window around it is encoded again and grows
  until it ends, on either side, in a token that the side has too: same id, same span. All neighbouring tokens of the
  result then stand together in one BPE result already, which for BPE makes the whole sequence the right one. Spans are
  kept for the ends of a leaf alone, and made for the whole of it if a window grows beyond them.

Defined results: a null text is an empty text and has no ids; repeated rows give repeated rows; null ids pass through;
other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.llm.common import bound_batches

LEAF_CHARS = 32_768
EDGE_CHARS = 4_096
MEMO_UNITS = 400_000
MEMO_PIECES = 30_000
WINDOW = 16
BATCH_CHARS = 2_000_000


# A pattern of words, and the normalizers under which ASCII letters only lose their case.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"


def _plain(*kinds: str) -> str:
    """Characters of these kinds that NFC leaves alone beside each other and that have one lower case each: printable ASCII,
    Latin letters but for the dotted capital I, and signs of Western texts."""
    ranges = (range(0x21, 0x7F), range(0xA1, 0x130), range(0x131, 0x180), range(0x2010, 0x2028), range(0x20A0, 0x20AD))
    return "".join(chr(p) for r in ranges for p in r if unicodedata.category(chr(p))[0] in kinds)


PLAIN = _plain("L", "N", "P", "S")
PLAIN_WORDS = (f"'s|'t|'re|'ve|'m|'ll|'d|[{_plain('L')}]+|[{_plain('N')}]|[{re.escape(_plain('P', 'S'))}]+")


class Piece:
    """A piece of text with its ids and the span of each in the piece; starts and ends are -1 where they are not known."""

    __slots__ = ("text", "ids", "starts", "ends")

    def __init__(self, text: str, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.text, self.ids, self.starts, self.ends = text, ids, starts, ends

    def pack(self) -> bytes:
        """Spans change little from token to token, so differences compress to about a byte each."""
        rows = np.stack([self.ids, np.diff(self.starts, prepend=0), self.ends - self.starts]).astype("<i4")
        return zstandard.compress(rows.tobytes(), 1)

    @classmethod
    def unpack(cls, text: str, blob: bytes) -> Piece:
        ids, steps, lengths = np.frombuffer(zstandard.decompress(blob), "<i4").reshape(3, -1).astype(np.int64)
        starts = np.cumsum(steps)
        return cls(text, ids, starts, starts + lengths)

    def ends_known(self) -> tuple[int, int]:
        """How many tokens from either end on have known spans."""
        unknown = self.starts < 0
        if not unknown.any():
            return len(self.ids), len(self.ids)
        return int(np.argmax(unknown)), int(np.argmax(unknown[::-1]))


def drops_space(config: dict) -> bool:
    """Whether the pre-tokenizer keeps only matches of a pattern that has no white space in them."""
    stage = config.get("pre_tokenizer") or {}
    first = (stage.get("pretokenizers") or [stage])[0]
    pattern = (first.get("pattern") or {}).get("Regex", " ")
    negated = re.findall(r"\[\^[^\]]*\]", pattern)
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and " " not in pattern and all(r"\s" in x for x in negated) and r"\s" not in re.sub(r"\[\^[^\]]*\]", "", pattern))


def word_splitter(config: dict) -> bool:
    """Whether the tokenizer drops white space and cuts by `WORDS` after `NORMALIZERS`, bytes and nothing else following."""
    stages = (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    return (drops_space(config) and len(stages) == 2 and (stages[0].get("pattern") or {}).get("Regex") == WORDS
            and all(stages[1].get(k) == v for k, v in byte_level.items())
            and (config.get("normalizer") or {}).get("normalizers") == NORMALIZERS)


class Memo(dict):
    """Ids of recent units, learned when they are asked for. Units live for two generations, so frequent ones stay and
    rare ones go."""

    def __init__(self, learn: Callable[[str], bytes], most: int):
        super().__init__()
        self.learn, self.half, self.old = learn, most // 2, {}

    def __missing__(self, unit: str) -> bytes:
        found = self.old.get(unit)
        if found is None:
            found = self.learn(unit)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[unit] = found
        return found


class Codec:
    """The tokenizer of one file, with the results of recent units."""

    def __init__(self, path: str, memo_units: int = MEMO_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks; threads of each would only wait for others
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.by_unit = drops_space(config)
        self.added = [t["content"] for t in config.get("added_tokens") or []]
        self.reach = max(map(len, self.added), default=1)
        self.by_word = word_splitter(config)
        if self.by_word:
            self.model = self.tok.model
            to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.as_bytes = {ord(c): to_bytes(c)[0][0] for c in PLAIN}
            self.ascii_words = re.compile(ASCII_WORDS, re.ASCII).findall
            self.plain_words = re.compile(PLAIN_WORDS, re.ASCII).findall
            self.is_plain = re.compile(f"[{re.escape(PLAIN)}\\s]*", re.ASCII).fullmatch
            self.words = re.compile(r"[^\s\x80-\U0010ffff]*[\x80-\U0010ffff]\S*|" + ASCII_WORDS, re.ASCII).findall
            self.specials = [a.encode() for a in self.added]
        self.memo = Memo(self._learn, memo_units)
        self.pieces: dict[str, Piece] = {}

    @property
    def old(self) -> dict[str, bytes]:
        return self.memo.old

    def _learn(self, unit: str) -> bytes:
        """The ids of a unit. Where words are known, the model itself is asked for each of them."""
        if not self.by_word or not self.is_plain(unit):
            ids = self.tok.encode_batch_fast([unit], add_special_tokens=False)[0].ids
        else:
            words = self.plain_words(unit.lower())
            if len(words) > 1:
                return b"".join(map(self.memo.__getitem__, words))
            ids = [t.id for w in words for t in self.model.tokenize(w if w.isascii() else w.translate(self.as_bytes))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _units(self, text: bytes) -> list[str]:
        """What the tokenizer treats on its own, in order. A unit with other than plain characters stays whole."""
        if not self.by_word:
            return [u.decode() for u in text.split()]
        low = text.lower().decode()  # ASCII letters alone
        if low.isascii():
            return self.ascii_words(low)
        return self.plain_words(low.lower()) if self.is_plain(low) else self.words(low)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole UTF-8 texts as little-endian unsigned 32-bit integers."""
        if not self.by_unit:
            found = self.tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        known = self.memo.__getitem__
        return [np.array(self.tok.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes()
                if self.by_word and any(a in t for a in self.specials) else b"".join(map(known, self._units(t))) for t in texts]

    def decode(self, ids: bytes) -> str:
        return self.tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)

    def piece(self, text: str) -> Piece:
        """Encode a piece with spans."""
        return _spanned(text, self.tok.encode(text, add_special_tokens=False))

    def leaf(self, text: str, edge: int = EDGE_CHARS) -> Piece:
        """As `piece`, unit by unit where the tokenizer allows it, with spans for about `edge` characters at either end."""
        if not self.by_unit:
            return self.piece(text)
        head_end, tail_begin = text.rfind(" ", 0, edge), text.find(" ", max(0, len(text) - edge))
        if len(text) <= 2 * edge or head_end < 0 or tail_begin < 0 or any(a in text for a in self.added):
            return self.spanned(text)
        ids = np.frombuffer(self.encode([text.encode()])[0], "<u4").astype(np.int64)
        head, tail = self.spanned(text[:head_end]), self.spanned(text[tail_begin:])
        unknown = np.full(len(ids) - len(head.ids) - len(tail.ids), -1, np.int64)
        return Piece(text, ids, np.concatenate([head.starts, unknown, tail.starts + tail_begin]),
                     np.concatenate([head.ends, unknown, tail.ends + tail_begin]))

    def spanned(self, text: str) -> Piece:
        """As `piece`, unit by unit, with all spans."""
        units = [(m.start(), m.group()) for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text)]
        if not units:
            return Piece(text, *(np.zeros(0, np.int64) for _ in range(3)))
        if len(self.pieces) > MEMO_PIECES:
            self.pieces = {}
        new = list({u for _, u in units} - self.pieces.keys())
        for u, e in zip(new, self.tok.encode_batch(new, add_special_tokens=False), strict=True):
            self.pieces[u] = _spanned(u, e)
        found = [self.pieces[u] for _, u in units]
        shift = np.repeat([s for s, _ in units], [len(p.ids) for p in found])
        return Piece(text, np.concatenate([p.ids for p in found]), np.concatenate([p.starts for p in found]) + shift,
                     np.concatenate([p.ends for p in found]) + shift)

    def cut(self, text: str, near: int) -> int:
        """The first place from `near` on where the text may be cut: before a character that joins no other, and not
        inside the text of an added token. The end of the text if there is none."""
        p = near
        while p < len(text):
            inside = [i + len(a) for a in self.added for i in range(max(0, p - self.reach), p)
                      if i + len(a) > p and text.startswith(a, i)]
            if inside:
                p = max(inside)
            elif not plain(text[p]):
                p += 1
            else:
                break
        return min(p, len(text))

    def halves(self, text: str, leaf_chars: int) -> list[str]:
        """The leaves of the tree over `text`, from left to right."""
        if len(text) <= leaf_chars:
            return [text]
        middle = self.cut(text, len(text) // 2)
        if middle >= len(text):
            return [text]
        return self.halves(text[:middle], leaf_chars) + self.halves(text[middle:], leaf_chars)

    def join(self, a: Piece, b: Piece) -> Piece:
        """One piece from two neighbours."""
        text, shift = a.text + b.text, len(a.text)
        reach = WINDOW
        tail_known, head_known = a.ends_known()[1], b.ends_known()[0]
        starts, ends = _moved(b.starts, shift), _moved(b.ends, shift)
        while True:
            if 2 * reach > min(tail_known, head_known):  # twice: a window may grow to the next clean token
                if tail_known < len(a.ids):
                    a, tail_known = self.spanned(a.text), len(a.ids)
                if head_known < len(b.ids):
                    b, head_known = self.spanned(b.text), len(b.ids)
                    starts, ends = _moved(b.starts, shift), _moved(b.ends, shift)
            left = max(0, len(a.ids) - reach)
            while left > 0 and not _clean(a.starts, a.ends, left, text):
                left -= 1
                if a.starts[left] < 0 or left and a.ends[left - 1] < 0:
                    a, tail_known = self.spanned(a.text), len(a.ids)
            right = min(len(b.ids), reach)
            while right < len(b.ids) and not _clean(starts, ends, right, text):
                right += 1
                if right < len(b.ids) and starts[right] < 0:
                    b, head_known = self.spanned(b.text), len(b.ids)
                    starts, ends = _moved(b.starts, shift), _moved(b.ends, shift)
            begin = int(a.starts[left]) if left else 0
            end = int(starts[right]) if right < len(b.ids) else len(text)
            w = self.piece(text[begin:end])
            ws, we = w.starts + begin, w.ends + begin
            head = 0 if not left else 1 if len(w.ids) and _same(a.ids, a.starts, a.ends, left, w.ids, ws, we, 0) else None
            tail = (len(w.ids), len(b.ids)) if right == len(b.ids) else None
            if tail is None and head is not None:
                near = zip(b.ids[:right].tolist(), starts[:right].tolist(), ends[:right].tolist(), strict=True)
                place = {token: k for k, token in enumerate(near)}
                for m in range(len(w.ids) - 2, head - 1, -1):
                    k = place.get((int(w.ids[m]), int(ws[m]), int(we[m])))
                    if k is not None and _clean(ws, we, m, text) and _clean(starts, ends, k + 1, text):
                        tail = (m, k)
                        break
            if head is not None and tail is not None:
                m, k = tail
                return Piece(text, np.concatenate([a.ids[:left], w.ids[:m], b.ids[k:]]),
                             np.concatenate([a.starts[:left], ws[:m], starts[k:]]),
                             np.concatenate([a.ends[:left], we[:m], ends[k:]]))
            reach *= 2

    def tree(self, pieces: list[Piece]) -> Piece:
        """Join neighbours pair by pair, level by level."""
        while len(pieces) > 1:
            pieces = [self.join(*pieces[i:i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
        return pieces[0]


def _spanned(text: str, encoding) -> Piece:
    spans = np.array(encoding.offsets, np.int64).reshape(-1, 2)
    return Piece(text, np.array(encoding.ids, np.int64), spans[:, 0], spans[:, 1])


def _moved(places: np.ndarray, shift: int) -> np.ndarray:
    return np.where(places < 0, -1, places + shift)


def plain(ch: str) -> bool:
    """A character that never joins with the one before it: no mark, and no Korean vowel or final letter."""
    return ch < "̀" or (unicodedata.combining(ch) == 0 and unicodedata.category(ch)[0] != "M"
                             and not "ᅠ" <= ch <= "ᇿ" and not "ힰ" <= ch <= "퟿")


def _clean(starts: np.ndarray, ends: np.ndarray, i: int, text: str) -> bool:
    """Whether token `i` begins where the one before it has ended; tokens of one character's bytes share a span."""
    return i >= len(starts) or ((i == 0 or starts[i] >= ends[i - 1]) and plain(text[int(starts[i])]))


def _same(ids, starts, ends, i, ids2, starts2, ends2, j) -> bool:
    return (ids[i], starts[i], ends[i]) == (ids2[j], starts2[j], ends2[j])


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def bounded(texts: list[bytes | None], most: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of about `most` bytes."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _digest(c: Codec, ids: bytes) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  leaf_chars: int = LEAF_CHARS, keep: bool = False) -> DataFrame:
    """Ids of every whole text and the text decoded from them.

    Gives `id_col`, `n_tokens`, `ids_sha256`, `decoded_sha256`; with `keep` also `ids` (little-endian unsigned 32-bit
    integers) and `decoded`. `path` must be readable on every executor.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = f"{id_col} {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" if keep else ""
    names = [f.split()[0] for f in schema.split(", ")]
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def rows(c: Codec, ids: bytes) -> tuple:
        return (*_digest(c, ids), ids, c.decode(ids)) if keep else _digest(c, ids)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            for part in bounded(raw):
                found = list(zip(*[rows(c, ids) for ids in c.encode(raw[part])], strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], *[pa.array(x) for x in found]], names=names)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for i in range(batch.num_rows):
                cut = c.halves(batch.column(2)[i].as_py(), leaf_chars)
                n = len(cut)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, batch.column(0).type),
                     pa.array([batch.column(1)[i].as_py()] * n, batch.column(1).type),
                     pa.array(range(n), pa.int32()), pa.array(cut)], names=["row", id_col, "leaf", "text"])

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                blob = c.leaf(one.column(3)[0].as_py()).pack()
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([blob], pa.binary())],
                                                 names=["row", id_col, "leaf", "text", "tokens"])

    def join_leaves(table: pa.Table) -> pa.Table:
        c = codec(path)
        table = table.sort_by("leaf")
        pieces = [Piece.unpack(t.as_py(), b.as_py()) for t, b in zip(table["text"], table["tokens"], strict=True)]
        got = rows(c, c.tree(pieces).ids.astype("<u4").tobytes())
        return pa.Table.from_arrays([table[id_col].slice(0, 1), *[pa.array([x]) for x in got]], names=names)

    long = F.length("text") > leaf_chars
    short_rows = texts.where(~long).mapInArrow(whole, schema)
    cut = (texts.where(long).select(F.monotonically_increasing_id().alias("row"), id_col, "text")
           .mapInArrow(leaves, f"row long, {id_col} {kind.simpleString()}, leaf int, text string"))
    # few large rows: spread them by leaf, whatever the split they were read in
    encoded = cut.repartition("row", "leaf").mapInArrow(
        encode_leaves, f"row long, {id_col} {kind.simpleString()}, leaf int, text string, tokens binary")
    return short_rows.unionByName(encoded.groupBy("row").applyInArrow(join_leaves, schema))
