"""Byte-level BPE: texts to token ids and back, with a local file of ranks.

``tiktoken`` cuts a text by the pattern and merges the bytes of every match. A
long text is first cut into parts where a match ends whatever stands around it:
no match of the pattern goes from a letter or digit to another kind of
character, and white space stands only at a match's beginning. The parts' ids,
joined, are those of the whole. Decoding joins the tokens' raw bytes, so ids
that end inside a character decode too.

``tiktoken`` can't match a run of about a million blanks or line ends. Such a
part is matched by ``regex`` with the same pattern, and its matches are merged
one by one.

Scale: one pass without a shuffle; the encoder is made once a worker.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import text_bytes

#: Code points from which a text is cut before it is encoded, and of the parts.
PART = 1 << 18
# Characters whose kind no Unicode version disputes. The apostrophe joins letters behind it, white space anything.
_LETTER = r"A-Za-zÀ-ÖØ-öø-ɏА-яぁ-ゖァ-ヺ一-龥가-힣"
_DIGIT, _BLANK, _MARK = "0-9", r" \t\n\r\f\v", r"!-&(-/:-@\[-`{-~、-〃！，？"
_SAFE = regex.compile(f"(?<=[{_LETTER}])(?=[{_DIGIT}{_MARK}{_BLANK}])|(?<=[{_DIGIT}])(?=[{_LETTER}{_MARK}{_BLANK}])"
                      f"|(?<=[{_MARK}])(?=[{_LETTER}{_DIGIT}{_BLANK}])|(?<=')(?=[{_BLANK}])")


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def encoder(path: str):
    """The ``tiktoken`` encoder of a file of base64 tokens and ranks, without special tokens."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=_pattern(), mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART):
    """Parts of about ``size`` code points that begin where a match of the pattern begins."""
    a = 0
    while len(text) - a > size:
        cut = _SAFE.search(text, a + size)
        if cut is None:
            break
        yield text[a: cut.start()]
        a = cut.start()
    yield text[a:]


@lru_cache(maxsize=2)
def _matcher(pattern: str):
    return regex.compile(pattern)


def encode_part(text: str, path: str) -> np.ndarray:
    e = encoder(path)
    try:
        return e.encode_to_numpy(text, disallowed_special=()).astype("<u4")
    except ValueError:                                   # too long a run of white space for its matcher
        ids = [np.asarray(e._encode_single_piece(m.group().encode()), "<u4") for m in _matcher(_pattern()).finditer(text)]
        return np.concatenate(ids)


def encode_text(text: str, path: str, size: int = PART) -> np.ndarray:
    """The token ids of a whole text."""
    if len(text) <= size:
        return encode_part(text, path)
    return np.concatenate([encode_part(p, path) for p in parts(text, size)])


def decode_ids(ids: np.ndarray, path: str) -> bytes | None:
    """The raw bytes of the ids' tokens; None if one has no token."""
    e = encoder(path)
    try:
        return b"".join([e.decode_bytes(ids[a: a + PART].tolist()) for a in range(0, len(ids), PART)])
    except KeyError:
        return None


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers).

    A null text counts as empty and has no ids; text that looks like a special
    token is plain text; bytes that are no UTF-8 count as U+FFFD. Equal rows
    give equal ids, document ids may be null, other columns are ignored and an
    empty table gives no rows. Very long texts are encoded whole, part by part;
    a long run of one kind of characters is one part and, as one match, takes
    some 60 times its bytes of memory. ``ranks`` is the path of
    a file that every executor has.
    """
    def run(arr: pa.Array) -> pa.Array:
        path = ranks or ranks_path()
        return pa.array([encode_text(t.as_py().decode("utf-8", "replace"), path).tobytes() for t in arr], pa.binary())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.arrow_udf(run, "binary")(text_bytes(text_col)).alias("ids"))
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode(ids: Column, ranks: str | None = None) -> Column:
    """The bytes that ids as of ``encode`` stand for (null for null, or if an id has no token)."""
    @F.arrow_udf("binary")
    def run(arr: pa.Array) -> pa.Array:
        path = ranks or ranks_path()
        return pa.array([None if b is None else decode_ids(np.frombuffer(b, "<u4"), path) for b in arr.to_pylist()],
                        pa.binary())
    return run(ids)
