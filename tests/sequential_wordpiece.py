"""Plain one-merge-at-a-time trainer: the brute-force version for tests."""

from twinline.constants import CONTINUATION_PREFIX, SPECIAL_TOKENS


def sequential_wordpiece(word_counts: dict[str, int], vocab_size: int,
                         prefix: str = CONTINUATION_PREFIX) -> list[str]:
    chars_ = sorted({ch for w in word_counts for ch in w})
    conts = sorted({ch for w in word_counts for ch in w[1:]})
    tokens = list(SPECIAL_TOKENS) + chars_ + [prefix + ch for ch in conts]
    t2i = {t: i for i, t in enumerate(tokens)}
    words = {w: [t2i[w[0]]] + [t2i[prefix + ch] for ch in w[1:]] for w in word_counts}
    while len(tokens) < vocab_size:
        pc: dict[tuple[int, int], int] = {}
        for w, syms in words.items():
            for x, y in zip(syms, syms[1:]):
                pc[(x, y)] = pc.get((x, y), 0) + word_counts[w]
        if not pc:
            break
        (a, b), _ = min(pc.items(), key=lambda kv: (-kv[1], kv[0]))
        tb = tokens[b]
        joined = tokens[a] + (tb[len(prefix):] if tb.startswith(prefix) else tb)
        nid = t2i.get(joined)
        if nid is None:
            nid = len(tokens)
            tokens.append(joined)
            t2i[joined] = nid
        for w, syms in words.items():
            out: list[int] = []
            for s in syms:
                if out and out[-1] == a and s == b:
                    out[-1] = nid          # left to right; nid != a, so no re-merge
                else:
                    out.append(s)
            words[w] = out
    return tokens
