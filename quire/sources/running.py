"""A SHA-256 that one task begins and another goes on with."""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib

from pyspark.sql import SparkSession


def _library() -> ctypes.CDLL | None:
    """The crypto library that has the functions on a bare context, if there is one."""
    for name in (ctypes.util.find_library("crypto"), "libcrypto.so.3", "libcrypto.so.1.1", "libcrypto.so"):
        try:
            found = ctypes.CDLL(name) if name else None
            if found and all(hasattr(found, f"SHA256_{f}") for f in ("Init", "Update", "Final")):
                return found
        except OSError:
            continue
    return None


#: Bytes of OpenSSL's SHA256_CTX: eight words of state, the length in two, a block, and two counts.
_SIZE = 112


class Sha256:
    """As hashlib's, with a state that can be stored: 112 bytes, whatever was hashed."""

    def __init__(self, state: bytes | None = None) -> None:
        if (lib := _library()) is None:
            raise RuntimeError("no crypto library with SHA256_Init, SHA256_Update and SHA256_Final")
        for f, types in (("Init", [ctypes.c_void_p]), ("Update", [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]), ("Final", [ctypes.c_char_p, ctypes.c_void_p])):
            getattr(lib, f"SHA256_{f}").argtypes = types
        self.lib, self.context = lib, ctypes.create_string_buffer(state or bytes(_SIZE), _SIZE)
        if state is None:
            lib.SHA256_Init(self.context)

    def update(self, data: bytes) -> None:
        self.lib.SHA256_Update(self.context, data, len(data))

    def state(self) -> bytes:
        return self.context.raw

    def hexdigest(self) -> str:
        out, context = ctypes.create_string_buffer(32), ctypes.create_string_buffer(self.context.raw, _SIZE)
        self.lib.SHA256_Final(out, context)
        return out.raw.hex()


def goes_on(spark: SparkSession) -> bool:
    """Whether executors have the library."""
    return spark.sparkContext.parallelize([0], 1).map(lambda _: available()).first()


def available() -> bool:
    """Whether this process has the library, and it hashes as hashlib does when it goes on from a stored state."""
    try:
        h = Sha256()
        h.update(b"abc" * 50)
        h = Sha256(h.state())
        h.update(b"def")
        return h.hexdigest() == hashlib.sha256(b"abc" * 50 + b"def").hexdigest()
    except RuntimeError:
        return False
