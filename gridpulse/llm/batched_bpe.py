"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up all neighbouring pairs by binary
search over the sorted pair keys, takes the lowest rank of each word, merges where it stands, and
drops the words that are done. Words already met are kept in a bounded dictionary.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from gridpulse.llm.binary_packing import byte_letters
from gridpulse.llm.common import chunks, rows, small_batches

CACHED_WORDS = 200_000
WORDS_AT_ONCE = 4_096
NO_RANK = np.iinfo(np.int32).max


class BatchedBpe:
    """A BPE tokenizer file with word ends: NFC, one space for white space, lower case, cut by its pattern."""

    def __init__(self, tokenizer_json: str):
        file = json.loads(tokenizer_json)
        model = file["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*vocabulary.items(), *self.special.items()]:
            self.tokens[i] = token
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cut = regex.compile(file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.file, self.letters = tokenizer_json, byte_letters()
        letter = {b: c for c, b in self.letters.items()}
        self.inner = np.array([vocabulary[letter[b]] for b in range(256)], np.int64)
        self.final = np.array([vocabulary[letter[b] + end] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.keys, first = np.unique(keys, return_index=True)  # sorted; of a repeated pair the lowest rank
        self.ranks, self.made = first.astype(np.int32), made[first]
        self.decimals = [str(i) for i in range(self.size)]
        self.seen: dict[str, bytes] = {}
        self.known = None  # the library's tokenizer, once it is needed

    def look_up(self, symbol: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs that begin at these places; no rank across words or unknown."""
        after = np.minimum(at + 1, len(symbol) - 1)
        pair = symbol[at] * self.size + symbol[after]
        found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        real = (self.keys[found] == pair) & (owner[at] == owner[after]) & (after > at)
        return np.where(real, self.ranks[found], NO_RANK), self.made[found]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has."""
        data = [w.encode() for w in words]
        lengths = np.array([len(d) for d in data], np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(lengths)
        symbol = self.inner[flat]
        symbol[ends - 1] = self.final[flat[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank, made = self.look_up(symbol, owner, np.arange(len(symbol)))
        done_symbol, done_owner = [], []
        while len(symbol):
            head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(head, len(symbol)))
            low = np.minimum.reduceat(rank, head)
            over = low == NO_RANK
            if over.any():  # set aside the words that are done
                go = np.repeat(~over, size)
                done_symbol.append(symbol[~go])
                done_owner.append(owner[~go])
                symbol, owner, rank, made = symbol[go], owner[go], rank[go], made[go]
                low, size = low[~over], size[~over]
                if not len(symbol):
                    break
            chosen = rank == np.repeat(low, size)
            if (chosen[1:] & chosen[:-1]).any():  # of a run of equal symbols every second pair, from the left
                place = np.arange(len(chosen))
                start = np.maximum.accumulate(np.where(chosen & ~np.append(False, chosen[:-1]), place, 0))
                chosen &= (place - start) % 2 == 0
            first = np.flatnonzero(chosen)
            symbol[first] = made[first]
            stay = np.ones(len(symbol), bool)
            stay[first + 1] = False
            symbol, owner, rank, made = symbol[stay], owner[stay], rank[stay], made[stay]
            first -= np.arange(len(first))  # where the merged symbols are now; their pairs and those before are new
            fresh = np.unique(np.concatenate((first, np.maximum(first - 1, 0))))
            rank[fresh], made[fresh] = self.look_up(symbol, owner, fresh)
        symbol, owner = np.concatenate([*done_symbol, symbol]), np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        return symbol[order].astype("<u4"), np.bincount(owner, minlength=len(words))

    def words(self, text: str) -> list[str]:
        """Normalised text cut by the pattern; a sigma has one lower-case form.

        A text with code points that the standard library does not know yet is cut by the
        tokenizers library, whose tables are newer.
        """
        if not text.isascii():
            if any(unicodedata.category(c) == "Cn" for c in set(text)):
                known = self.known = self.known or Tokenizer.from_str(self.file)
                pieces = known.pre_tokenizer.pre_tokenize_str(known.normalizer.normalize_str(text))
                return [bytes(self.letters[c] for c in piece).decode() for piece, _ in pieces]
            text = unicodedata.normalize("NFC", text)
            text = text.replace("\N{GREEK CAPITAL LETTER SIGMA}", "\N{GREEK SMALL LETTER SIGMA}")
        text = text.lower()
        return self.cut.findall(text)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = []
        for text in texts:
            parts = self.cut_special.split(text) if self.cut_special and "<|" in text else [text]
            cut.append([p if p in self.special else self.words(p) for p in parts])
        seen = self.seen
        if len(seen) > CACHED_WORDS:
            seen.clear()
        new = list({w for parts in cut for p in parts if not isinstance(p, str) for w in p if w not in seen})
        for i in range(0, len(new), WORDS_AT_ONCE):
            some = new[i : i + WORDS_AT_ONCE]
            ids, counts = self.merge(some)
            data, ends = ids.tobytes(), np.cumsum(counts) * 4
            for word, start, end in zip(some, (ends - counts * 4).tolist(), ends.tolist()):
                seen[word] = data[start:end]
        made = []
        for parts in cut:
            found = [np.uint32(self.special[p]).tobytes() if isinstance(p, str) else b"".join([seen[w] for w in p]) for p in parts]
            made.append(np.frombuffer(b"".join(found), "<u4"))
        return made

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by a space: the file names no decoder, so word ends stay as they are."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])

    def as_text(self, ids: np.ndarray) -> str:
        decimals = self.decimals
        return " ".join([decimals[i] for i in ids.tolist()])


def round_trip(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256; with_ids adds ids and decoded.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows give equal rows, null ids stay null, other
    columns play no part.
    """
    spark = small_batches(docs.sparkSession)
    file = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = BatchedBpe(file.value)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for part, texts in chunks(batches, limit=1_000_000):
            ids = code.encode_batch(texts)
            made = {
                "doc_id": part.column("doc_id"),
                "n_tokens": np.array([len(x) for x in ids], np.int64),
                "ids_sha256": pa.array([sha(code.as_text(x)) for x in ids], pa.string()),
                "decoded_sha256": pa.array([sha(code.decode(x)) for x in ids], pa.string()),
            }
            if with_ids:
                made["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
                made["decoded"] = pa.array([code.decode(x) for x in ids], pa.string())
            yield rows(**made)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>, decoded string" * with_ids)
