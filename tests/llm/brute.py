"""Plain Python forms of the operators' contracts."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_rules(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n


def line_rules(rows, least_docs, share, remain):
    """(removed words, kept) for each (text, host)."""
    norm = lambda line: " ".join(WORD.findall(line)).lower()
    lines = lambda text: [x for x in (text or "").split("\n") if WORD.search(x)]
    texts, held = defaultdict(set), defaultdict(set)
    for text, host in rows:
        texts[host].add(text or "")
        for line in lines(text):
            held[host, norm(line)].add(text or "")
    often = {k for k, v in held.items() if len(v) >= least_docs and len(v) >= share * len(texts[k[0]])}
    out = []
    for text, host in rows:
        gone = sum(len(WORD.findall(x)) for x in lines(text) if (host, norm(x)) in often)
        n = len(WORD.findall(text or ""))
        out.append((gone, not base_rules(text)[5] and n - gone >= n * remain))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_classes(rows):
    """{doc_id: component} for (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    inverted, links = defaultdict(list), []
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in inverted[x]).items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                links.append((i, j))
        for x in s:
            inverted[x].append(i)
    return roots(sets, links)


def repeats(rows):
    """{doc_id: removed byte flags} for (doc_id, text) with distinct ids, taken in order of id."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        flags = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                flags[s : s + 100] = b"\1" * 100
            seen.add(w)
        out[i] = flags
    return out


def contamination(text, items):
    """(words, words hit, sorted items) of a text, for (item, text) items."""
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        w = ALNUM.findall((body or "").translate(LOWER))
        m = min(10, len(w))
        windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in windows:
                hit.update(range(i, i + m))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def fewest_pieces(word, scores, byte_score):
    """(score, pieces) of the best segmentation, by recursion over the rest of the word."""
    best = {len(word): (0.0, 0)}
    for i in range(len(word) - 1, -1, -1):
        options = [(scores[word[i:j]] + best[j][0], 1 + best[j][1]) for j in range(i + 1, len(word) + 1) if word[i:j] in scores]
        if word[i] not in scores:
            width = len(word[i].encode("utf-8"))
            options.append((width * byte_score + best[i + 1][0], width + best[i + 1][1]))
        best[i] = max(options, key=lambda o: (round(o[0], 9), -o[1]))
    return best[0]
