"""Token counts by the whole-token shortcut."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from entityspark.llm.common import PairMerger, arrow_batches, docs_of

#: The pre-token pattern of byte-level vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blocks whose characters both regex engines class alike (tested); a text with others goes to the library whole.
_OTHER = re.compile(r"[^\x00-ɏͰ-ͳЀ-џ‐-‧€ぁ-ゖ一-龥]")
#: A space that another white space follows belongs to one pre-token with it.
_RUN = re.compile(r" (?=\s|$)")
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_PIECE, _CACHE, _LONG = 1 << 20, 600_000, 48


def whole_tokens(path: str) -> dict[str, int]:
    """Every string of the vocabulary that is one pre-token and that the library alone encodes as one token: such a
    pre-token counts 1 wherever it stands, since merges never cross pre-tokens. As large as the vocabulary."""
    from tokenizers import Tokenizer, pre_tokenizers

    tok = Tokenizer.from_file(path)
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    split, texts = pre_tokenizers.ByteLevel(add_prefix_space=False), []
    for token in tok.get_vocab(with_added_tokens=False):
        text = tok.decoder.decode([token])
        if text and "�" not in text and text not in special and len(split.pre_tokenize_str(text)) == 1:
            texts.append(text)
    return {t: 1 for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)) if len(e.ids) == 1}


def pieces(text: str, size: int = _PIECE) -> Iterator[str]:
    """The text in pieces cut only before a space between two ASCII letters, where a pre-token always begins."""
    at = 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


class Counter(dict):
    """Tokens of a string of letters and signs that stands between two spaces, the space in front included, by the
    string. A pre-token never reaches over a space that no white space follows, so these counts add up. A string met
    first is cut into pre-tokens: whole tokens count 1, only the rest is merged by the library. Both caches are bounded."""

    def __init__(self, path: str, whole: dict[str, int]):
        from tokenizers import Tokenizer

        super().__init__({t[1:]: n for t, n in whole.items() if t[0] == " " and t[1:].strip()})
        self.tok, self.whole, self.known = Tokenizer.from_file(path), whole, dict(whole)
        self.merge = PairMerger(self.tok).ids
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.find = regex.compile(PRETOKEN).findall

    def __missing__(self, word: str) -> int:
        n = len(self.merge(" " + word)) if word.isalpha() else self.merged(self.find(" " + word))
        if len(word) < _LONG and "\n" not in word:
            if len(self) > _CACHE:
                self.clear()
            self[word] = n
        return n

    def merged(self, found: list[str]) -> int:
        """Tokens of pre-tokens."""
        total = 0
        for w in found:
            n = self.known.get(w)
            if n is None:
                n = len(self.merge(w))
                if len(w) < _LONG:
                    if len(self.known) > _CACHE // 4:
                        self.known = dict(self.whole)
                    self.known[w] = n
            total += n
        return total

    def tokens(self, text: str) -> int:
        if any(s in text for s in self.special) or not text.isascii() and _OTHER.search(text):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        total = 0
        for piece in pieces(text):
            if _RUN.search(piece):
                total += self.merged(self.find(piece))
                continue
            first, *words = piece.split(" ")
            total += sum(map(self.__getitem__, words)) + (self.merged(self.find(first)) if first else 0)
        return total


@lru_cache(1)
def _counter(path: str, shared: Broadcast) -> Counter:
    """One per worker process, so that later tasks find it filled."""
    return Counter(path, shared.value)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, as the library counts its whole text.

    tokenizer: path of a byte-level BPE file, readable on every executor. Null and empty text: 0 and 0; repeated rows
    are counted each. A text with the string of a special token, or with characters outside the blocks named above,
    is encoded by the library itself. One narrow pass, no shuffle; a worker's memory holds a batch and bounded caches.
    """
    arrow_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, known)
        for batch in batches:
            sizes = np.array([counter.tokens(t) if t else 0 for t in batch.column(1).to_pylist()], np.int64)
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(sizes), pa.array(sizes > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    d = docs_of(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
