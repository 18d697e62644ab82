"""ASCII-folded terms of texts, taken byte by byte."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Letters to lower case, digits and all bytes of non-ASCII characters as they are, the rest to blanks.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
#: The same terms for Spark's and DuckDB's regular expressions, once A-Z are lower-cased.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII digits, ASCII letters and non-ASCII characters; only A-Z are lower-cased."""
    return text.translate(_FOLD).split()


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of one text after another; a null text counts as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""
