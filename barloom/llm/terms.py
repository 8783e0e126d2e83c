"""Terms of letters and digits, found byte by byte: other ASCII characters part them, A-Z are lowered."""

from __future__ import annotations

import pyarrow as pa

from barloom.llm.arrow_text import Words

_KEPT = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)}
_UPPER = range(ord("A"), ord("Z") + 1)
#: What each byte of UTF-8 becomes: bytes of characters beyond ASCII stay, so none is torn apart.
_TABLE = bytes(b if b in _KEPT else b + 32 if b in _UPPER else 0x20 for b in range(256))


def terms_of(texts: pa.Array) -> Words:
    """The maximal runs of ASCII letters, digits and all other characters beyond ASCII."""
    texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    if data is None:
        return Words(texts, lower=False)
    plain = pa.py_buffer(data.to_pybytes().translate(_TABLE))
    return Words(pa.LargeStringArray.from_buffers(len(texts), ends, plain, offset=texts.offset), lower=False)
