"""Plain versions shared by tests."""

import re


def near_roots(texts: dict[int, str]) -> dict[int, int]:
    """Smallest id of each text's component of near copies, by all pairs that share a shingle."""
    sets, holders, root = {}, {}, {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d in sorted(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[d].lower())
        sets[d] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
        shared = {}
        for s in sets[d]:
            for other in holders.get(s, ()):
                shared[other] = shared.get(other, 0) + 1
            holders.setdefault(s, []).append(d)
        for other, both in shared.items():
            if 100 * both >= 80 * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((find(d), find(other)))
                root[b] = a
    return {d: find(d) for d in texts}
