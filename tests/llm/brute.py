"""Plain versions that the operators are held against."""


def components(nodes, links):
    """{node: least node reachable}"""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def simhash(text):
    import re

    import xxhash

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def dedup_lines(docs):
    """{id: text} of (id, text) rows with distinct ids, in order of id."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i: i + 3])
            if any(x.strip(" ") for x in w):
                if w in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(w)
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def tiling(p, t, least):
    """Covered tokens of p by greedy string tiling, longest match first."""
    free_p, free_t, covered = [True] * len(p), [True] * len(t), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while (i + n < len(p) and j + n < len(t) and free_p[i + n] and free_t[j + n]
                       and p[i + n] == t[j + n] >= 0):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        for k in range(n):
            free_p[i + k] = free_t[j + k] = False
        covered += n
