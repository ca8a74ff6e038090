"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
from collections import Counter


def repeated(texts, length):
    """Per text: (n_bytes, n_removed, n_spans, kept_sha256)."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
