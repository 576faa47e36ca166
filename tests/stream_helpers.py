"""Helpers of the stream tests (a module of its own: every folder may have a conftest)."""

import hashlib


def segment_of(key: str, n: int) -> int:
    """Python twin of the md5 routing rule (for choosing test keys)."""
    pos = int(hashlib.md5(key.encode()).hexdigest()[:8], 16)
    return (pos * n) >> 32


def keys_for_segments(n: int) -> list[str]:
    """One routing key per segment 0..n-1."""
    found = {}
    i = 0
    while len(found) < n:
        k = f"k{i}"
        found.setdefault(segment_of(k, n), k)
        i += 1
    return [found[s] for s in range(n)]
