"""SHA-256 whose state can be handed from one task to the next."""

from __future__ import annotations

import _hashlib
import ctypes
import ctypes.util

#: bytes that mark UTF-8 at the beginning of a text file
UTF8_MARK = b"\xef\xbb\xbf"


class _Context(ctypes.Structure):
    """OpenSSL's SHA256_CTX."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32), ("data", ctypes.c_uint32 * 16),
                ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


def _library() -> ctypes.CDLL:
    """The library that hashlib itself uses (its digests keep their state to themselves)."""
    for name in (_hashlib.__file__, ctypes.util.find_library("crypto")):
        lib = ctypes.CDLL(name) if name else None
        if lib is not None and hasattr(lib, "SHA256_Update"):
            lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
            return lib
    raise OSError("OpenSSL's SHA256_Update was not found")


class Sha256:
    """Digest that goes on from ``state()`` of an earlier one, empty for a new one."""

    def __init__(self, state: bytes = b""):
        self._lib = _library()
        self._context = _Context.from_buffer_copy(state) if state else _Context()
        if not state:
            self._lib.SHA256_Init(ctypes.byref(self._context))

    def update(self, data: bytes) -> None:
        self._lib.SHA256_Update(ctypes.byref(self._context), data, len(data))

    def state(self) -> bytes:
        return bytes(self._context)

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self._lib.SHA256_Final(out, ctypes.byref(_Context.from_buffer_copy(self.state())))
        return out.raw.hex()
