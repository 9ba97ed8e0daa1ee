"""Plain Python answers to the operators' contracts, for tests."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows(sf_dir, name, *columns):
    t = pq.read_table(f"{sf_dir}/{name}.parquet", columns=list(columns))
    return list(zip(*(t.column(c).to_pylist() for c in columns), strict=True))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode("utf-8", "surrogatepass")).hexdigest()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def op1(docs, items):
    owners = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall(lowered(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            owners[tuple(w[i:i + 13])].add(item)
    sizes = {len(k) for k in owners}
    out = []
    for doc, text in docs:
        w = BENCH_WORD.findall(lowered(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                ids = owners.get(tuple(w[i:i + size]))
                if ids:
                    hit |= set(range(i, i + size))
                    found |= {x for x in ids if x is not None}
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def op2(pages, sites):
    out = []
    for page, url in pages:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = lowered(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fits = []
        for site, verdict in sites:
            h, _, p = site.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(site), site, verdict))
        best = max(fits, default=None)
        out.append((page, host, path, best and best[1], best and best[2]))
    return out


def op3(turns):
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        convs[conv].append((turn, role or "", text or ""))
    out = []
    for conv, got in convs.items():
        got.sort()
        loss = "".join(t for _, r, t in got if r == "assistant")
        out.append((conv, len(got), sha("".join(f"{r}\n{t}\n" for _, r, t in got)), len(loss), sha(loss)))
    return out


def op4(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        w = SPACE_WORD.findall(text)
        lines = [s for s in text.split("\n") if SPACE_WORD.search(s)]
        at = defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        hit = {j for starts in at.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)}
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
                    len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)))
    return out


def op5(docs, size=400):
    bodies = [(d, (t or "").encode("utf-8", "surrogatepass")) for d, t in docs]
    count = Counter(b[i:i + size] for _, b in bodies for i in range(len(b) - size + 1))
    out = []
    for doc, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i:i + size] = b"\x01" * size
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), sha(kept)))
    return out


def op6_targets(sizes):
    """sizes: (doc, source, size) -> {source: target}"""
    total = Counter()
    for _, s, n in sizes:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left = {}, sum(total.values())
    open_ = set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * total[s]}
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
        open_ -= over
    return target


def op8(docs, path):
    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    start, out = 0, []
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def op10(docs, size=50):
    first = {}
    bodies = [(float("inf") if d is None else d, SPACE_WORD.findall(t or "")) for d, t in docs]
    for d, w in bodies:
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in bodies:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < d:
                gone |= set(range(i, i + size))
        out.append((None if d == float("inf") else d, len(w), len(gone),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shingles(text, size=5):
    w = SPACE_WORD.findall(text or "")
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def op9(docs):
    """(doc_id, class_id, n_links, n_copies) of every document; ids must differ."""
    sets, links = op9_links(docs)
    at = {s: i for i, s in enumerate(sets)}
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    degree, copies = Counter(), Counter(shingles(t) for _, t in docs)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
        up[max(top(i), top(j))] = min(top(i), top(j))
    head = {}
    for d, t in docs:
        if (s := shingles(t)) and d is not None:
            head[top(at[s])] = min(head.get(top(at[s]), d), d)
    return [(d, head.get(top(at[s])), degree[at[s]], copies[s] - 1) if (s := shingles(t)) else (d, d, 0, 0)
            for d, t in docs]


def op9_links(docs, least=0.8):
    """Pairs of different shingle sets with a Jaccard similarity of ``least`` or more."""
    sets = list({shingles(t) for _, t in docs} - {frozenset()})
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    out = set()
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in index[x] if j < i)
        for j, n in common.items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n) if least == 0.8 else n >= least * (len(s) + len(sets[j]) - n):
                out.add((j, i))
    return sets, out


def op12(docs, least=10, top=2000):
    """docs: (doc_id, text, lang)."""
    f = defaultdict(Counter)
    n = Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = set()
        for p, a in chosen.items():
            if len(p) == 3:
                held |= {q for q in (p[:2], p[1:]) if q in chosen and 100 * a >= 50 * chosen[q]}
        found = []
        for p, a in chosen.items():
            if p not in held:
                score, _, left, right = min(
                    (1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                    for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def op13(turns):
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    anew = {}
    for c, v in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - abs(c) % 5 * (1 if c >= 0 else -1)
        anew[c] = (*own.get(base, [])[:h], *v[h:])
    nodes = defaultdict(list)
    for c, v in anew.items():
        for d in range(len(v) + 1):
            nodes[v[:d]].append(c)
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, m in nodes.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += not children[k]
    return [(min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
             sha(",".join(map(str, sorted(c for c in m if len(anew[c]) == len(k)))))) for k, m in nodes.items()]
