"""SimHash near-dedup by its definition, one pair at a time."""

import re

import xxhash


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits=3):
    ids = list(fps)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= bits and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}
