"""Byte-level BPE with word ends: encoding and decoding against a public vocabulary file.

A word's symbols form a doubly linked list; a heap holds every adjacent pair that merges, by rank and then position, in one whole
number. The least entry is popped; if the two symbols that stand there no longer merge at its rank, the entry is stale and skipped,
else the pair becomes one symbol and its new neighbours are pushed. Words are cached up to a bound per Python worker.
Words of Latin-1 texts are sought by bitmaps of the file's character classes, those of other texts by the classes themselves.

Null texts are empty, and empty texts have no ids. Very long texts are taken whole. Rows are independent, so repeated
rows and ties need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

CACHE_WORDS, CACHE_CHARS = 400_000, 64  # words of one worker, and their length; about 100 MB
ENCODED = "struct<ids:array<int>,decoded:string>"
DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible Latin-1, else the next from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


# The vocabulary's library splits by Unicode 16 and lowers by Unicode 17, the libraries used here by other ones.
# Letters and digits that came after 16, as ranges, are neither; the lower forms that came with 16 and 17 are these.
LATER = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7
10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6
187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81
1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e
2cea2-2cead 323b0-33479 3d000-3fc3f"""
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
         **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}


BEYOND = re.compile("[\u0558-\U0010ffff]")  # holds all of them


def rare_class() -> tuple[str, str]:
    """Character classes of the later characters, and of these and the ones with late lower forms."""
    pairs = [(r.split("-")[0], r.split("-")[-1]) for r in LATER.split()]
    later = "".join(f"\\U{int(a, 16):08x}-\\U{int(b, 16):08x}" for a, b in pairs)
    return f"[{later}]", f"[{later}{''.join(map(chr, LOWER))}]"


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def latin_pattern(pattern: str) -> re.Pattern[str] | None:
    """A pattern that finds the same in Latin-1 texts: the members of its classes are written out. None if it has others than \\s, \\p{L} and
    \\p{N} within brackets."""
    def written_out(brackets: re.Match[str]) -> str:
        return re.sub(r"\\(?:s|p\{[LN]\})", lambda name: "".join(f"\\x{c:02x}" for c in range(256) if regex.match(name[0], chr(c))), brackets[0])

    pattern = re.sub(r"\[[^\]]*\]", written_out, pattern)
    return None if re.search(r"\\[^x]", pattern) else re.compile(pattern)


class WordCache(dict):
    """Packed ids of words. Full, it becomes the old half, of which only what is met again is taken over."""

    def __init__(self, packed: Callable[[str], bytes]) -> None:
        super().__init__()
        self.packed, self.old = packed, {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.packed(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS // 2:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


@functools.cache
def coder_of(path: str) -> WordBpe:
    """One coder for each file and Python worker."""
    return WordBpe(path)


class WordBpe:
    """Encoder and decoder of one vocabulary file, read where it is installed."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # The symbol of a byte, and of one that ends a word.
        self.first, self.last = ({b: self.ids[c + end] for b, c in enumerate(byte_symbols()) if c + end in self.ids} for end in ("", self.end))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Ranks of pairs by their first and then their second symbol, and the symbol made at each rank.
        self.ranks: list[dict[int, int]] = [{}] * (1 + max(self.ids.values()))
        for rank, (a, b) in enumerate(pairs):
            self.ranks[self.ids[a]] = self.ranks[self.ids[a]] or {}
            self.ranks[self.ids[a]][self.ids[b]] = rank
        self.made = [self.ids[a + b] for a, b in pairs]
        self.names = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for name, i in [*self.ids.items(), *self.special.items()]:
            self.names[i] = name
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.pattern, self.latin = regex.compile(pattern), latin_pattern(pattern)
        self.later, self.rare = map(regex.compile, rare_class())
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cache = WordCache(self._packed_word)

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word by merging."""
        raw = word.encode("utf-8")
        first, ranks, made = self.first, self.ranks, self.made
        ids = [first[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = len(ids)
        heap = [rank * n + i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := ranks[a].get(b)) is not None]
        if not heap:
            return ids
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank = entry // n
            i = entry - rank * n
            j = after[i]
            if j < 0 or ranks[ids[i]].get(ids[j]) != rank:
                continue  # stale
            new = ids[i] = made[rank]
            left, right = before[i], after[j]
            ids[j], after[i], after[j] = -1, right, -1
            if right >= 0:
                before[right] = i
                if (rank := ranks[new].get(ids[right])) is not None:
                    heapq.heappush(heap, rank * n + i)
            if left >= 0 and (rank := ranks[ids[left]].get(new)) is not None:
                heapq.heappush(heap, rank * n + left)
        return [i for i in ids if i >= 0]

    def _packed_word(self, word: str) -> bytes:
        ids = self.encode_word(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _words(self, part: str) -> list[str]:
        """Words of the lower-case text by the file's pattern. A private character stands for later ones while words are sought."""
        if BEYOND.search(part) is None or self.rare.search(part) is None:
            return self.pattern.findall(part.lower())
        part = part.translate(LOWER).lower()
        return [part[m.start(): m.end()] for m in self.pattern.finditer(self.later.sub("\ue000", part))]

    def _packed(self, part: str) -> list[bytes]:
        if self.latin is not None and _is_latin(part):  # is in NFC, and has neither sigma nor later characters
            words = self.latin.findall(part.lower())
        else:
            if not unicodedata.is_normalized("NFC", part):
                part = unicodedata.normalize("NFC", part)
            # Lower case by character: no special form of sigma at the end of a word.
            words = self._words(part.replace("Σ", "σ"))
        return list(map(self.cache.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as little-endian unsigned 32-bit integers. Strings of special tokens in it are those tokens."""
        if self.specials is None or self.specials.search(text) is None:
            return np.frombuffer(b"".join(self._packed(text)), "<u4")
        packed: list[bytes] = []
        for part in self.specials.split(text):
            if part in self.special:
                packed.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                packed += self._packed(part)
        return np.frombuffer(b"".join(packed), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Vocabulary strings, one after the other with a space between: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def encode_column(text: Column, path: str) -> Column:
    """``ids`` and ``decoded`` of each text."""
    @F.arrow_udf(ENCODED)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(path)
        for batch in batches:
            ids = [coder.encode(value.as_py() or "") for value in batch]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = np.concatenate([np.zeros(0, "<u4"), *ids]).view("<i4")
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array(map(coder.decode, ids), pa.string())],
                names=["ids", "decoded"])

    return encoded(text)


def digest_column(text: Column, path: str) -> Column:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each text: the digests of what ``encode_column`` gives,
    without moving ids and decoded texts out of the worker."""
    @F.arrow_udf(DIGESTS)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for value in batch:
                ids = coder.encode(value.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_text.append(hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
