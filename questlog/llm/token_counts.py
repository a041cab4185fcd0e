"""Token counts: pre-tokens proven to be one token are counted, only others merged."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from questlog.llm.pretokens import Kept, cut, pre_tokens

# Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: From here on letter and number classes differ between Unicode versions; such parts are left to the tokenizer.
NEWER = "\U00010000"


def byte_letters() -> dict[str, int]:
    """Letter of a byte-level vocabulary to its byte: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(tokenizer_file: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and encode, alone, as one token.

    Proved by encoding each. A string whose bytes are no UTF-8 cannot be a
    pre-token. The set is bounded by the vocabulary.
    """
    tokenizer, letters = Tokenizer.from_file(tokenizer_file), byte_letters()
    with open(tokenizer_file, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = []
    for token in vocabulary:
        try:
            words.append(bytes(letters[c] for c in token).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    pattern = regex.compile(PATTERN)
    words = [w for w in words if pattern.findall(w) == [w]]
    found = tokenizer.encode_batch_fast(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, found) if len(e.ids) == 1)


def token_counts(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens) per row, as the byte-level BPE of ``tokenizer_file`` counts.

    No begin, end or added special tokens; a special token's string inside a
    text is one token, the library's default. A null text counts as empty:
    0 bytes, 0 tokens. Repeated rows and null ids stay. A map over rows: texts
    are read whole, a worker keeps a bounded number of counted parts.
    """
    whole = whole_tokens(tokenizer_file)
    with open(tokenizer_file, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file)["added_tokens"]]
    state: dict = {}

    def counter():
        """Counts of parts, built once in each worker."""
        if not state:
            tokenizer, pattern = Tokenizer.from_file(tokenizer_file), regex.compile(PATTERN)
            tokenizer.encode_special_tokens = True

            def merged(text: str) -> int:
                return len(tokenizer.encode(text, add_special_tokens=False).ids)

            def count(part: str) -> int:
                if max(part) >= NEWER:
                    return merged(part)
                return sum(1 if w in whole else merged(w) for w in pre_tokens(part, pattern.findall))

            specials = regex.compile("|".join(map(regex.escape, special))) if special else None
            state.update(kept=Kept(count), after=Kept(lambda part: count(" " + part)), specials=specials)
        return state["kept"], state["after"], state["specials"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, after, specials = counter()

        def total(text: str) -> int:
            parts, spaced = cut(text)
            return sum(map(kept.__getitem__, parts)) + sum(map(after.__getitem__, spaced))

        for batch in batches:
            sizes, counts = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                pieces = specials.split(text) if specials and "<" in text else [text]
                counts.append(len(pieces) - 1 + sum(map(total, pieces)))
                sizes.append(len(text.encode()))
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
