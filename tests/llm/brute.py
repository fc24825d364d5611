"""Plain versions of the operators: small, slow and obvious."""

import base64
import hashlib
import re
import zlib

import numpy as np
import xxhash


def low(text):
    return (text or "").encode().lower()


def simhash(text):
    words = low(text).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    """The smallest index that pairs connect each index with."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_duplicates(rows):
    """rows: (doc_id, text), no NULL ids -> {(doc_id, fingerprint hex, component)} as a sorted list."""
    rows = sorted(rows, key=lambda r: r[0])
    prints = np.array([simhash(t) for _, t in rows], np.uint64)
    pairs = []
    for i in range(len(rows)):
        near = np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3)
        pairs += [(i, i + 1 + int(j)) for j in near]
    root = roots(len(rows), pairs)
    return [(r[0], f"{int(p):016x}", rows[root[i]][0]) for i, (r, p) in enumerate(zip(rows, prints))]


def substrings(rows, width=50):
    """rows: (doc_id, text) -> sorted list of (doc_id, n_words, n_removed, sha256 of kept)."""
    first = {}
    texts = [(id, (text or "").encode().split()) for id, text in rows]
    for id, words in texts:
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            if id is not None:
                first[key] = min(id, first.get(key, id))
    out = []
    for id, words in texts:
        gone = set()
        for i in range(len(words) - width + 1):
            if id is not None and first[tuple(words[i : i + width])] < id:
                gone.update(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def warc(rows):
    """rows: (page_id, html) -> sorted list of the contract's columns."""
    largest = {}
    for id, html in rows:
        key = (html or "").encode()
        largest[key] = max([x for x in (id, largest.get(key)) if x is not None], default=None)
    out = []
    for id, html in rows:
        body = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = id != largest[body]
        out.append((id, len(body), sha, "revisit" if again else "response", largest[body] if again else None))
    return sorted(out, key=str)


def close_vectors(rows, least=0.9):
    """rows: (vec_id, vector) with distinct ids -> sorted (vec_id, n_links, component, kept)."""
    rows = sorted(rows, key=lambda r: r[0])

    def unit(v):
        if v is None or any(x is None for x in v):
            return None
        v = np.asarray(v, float)
        norm = np.sqrt((v * v).sum())
        return v / norm if len(v) and np.isfinite(norm) and norm > 0 else None

    units = [unit(v) for _, v in rows]
    pairs = []
    for i, a in enumerate(units):
        for j in range(i + 1, len(units)):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= least:
                pairs.append((i, j))
    links = np.zeros(len(rows), int)
    for pair in pairs:
        links[list(pair)] += 1
    root = roots(len(rows), pairs)
    return [(r[0], int(links[i]), rows[root[i]][0], root[i] == i) for i, r in enumerate(rows)]


def merkle(rows, tampered=3):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, proof
    hash, folded root, verified)."""

    def h(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def leaf(values):
        values = [None if v is None else str(v) for v in values]
        return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))

    def runs(nodes):
        return [nodes[i : i + 8] for i in range(0, len(nodes), 8)]

    def top(nodes):
        while len(nodes) > 1:
            nodes = [h("".join(run)) for run in runs(nodes)]
        return nodes[0]

    def path(nodes, at):
        out = []
        while len(nodes) > 1:
            run, place = runs(nodes)[at // 8], at % 8
            out.append(("".join(run[:place]), "".join(run[place + 1 :])))
            nodes, at = [h("".join(run)) for run in runs(nodes)], at // 8
        return out

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for found in groups.values():
        found.sort(key=lambda x: x[:3])
    subroots = [top([x[2] for x in groups[lang]]) for lang in langs]
    out = []
    for place, lang in enumerate(langs):
        leaves = [x[2] for x in groups[lang]]
        for at, (_, _, node, row) in enumerate(groups[lang]):
            proof = path(leaves, at) + path(subroots, place)
            touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % tampered == 0
            text = row[4] and row[4].encode().lower().decode() if touched else row[4]
            up = leaf((*row[:4], text))
            for left, right in proof:
                up = h(left + up + right)
            proof = h("".join(left + right for left, right in proof))
            out.append((row[0], node, subroots[place], top(subroots), proof, up, up == top(subroots)))
    return sorted(out, key=str)


def spellings(rows, rare=97, least=5, often=3):
    """rows: (doc_id, text) -> sorted (word, form, root, n, n_near, form_n), by all pairs."""
    count = {}
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % rare == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] = count.get(run, 0) + 1
    count = {w: n for w, n in count.items() if len(w) >= least and n >= often}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, size = {}, {}
    for w in count:
        found = [v for v in count if abs(len(v) - len(w)) < 2 and near(v, w)]
        size[w] = len(found)
        best = min(found, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * count[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, size[w], count.get(form[w])) for w, n in count.items())
