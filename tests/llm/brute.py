"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def substring_dedup(docs, width=20):
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = WORDS.findall(text or "")
        keep = [True] * len(w)
        for p in range(len(w) - width + 1):
            g = tuple(w[p : p + width])
            if g in seen:
                keep[p : p + width] = [False] * width
            seen.add(g)
        kept = " ".join(a for a, b in zip(w, keep) if b)
        out[i] = (len(w), len(w) - sum(keep), sha(kept))
    return out


def jaccard(docs):
    sets = {}
    for i, text in docs:
        w = WORDS.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def byte_dedup(docs, width=400):
    data = {i: (t or "").encode() for i, t in docs}
    count = Counter(d[p : p + width] for d in data.values() for p in range(len(d) - width + 1))
    out = {}
    for i, d in data.items():
        gone = bytearray(len(d))
        for p in range(len(d) - width + 1):
            if count[d[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out[i] = (len(d), len(d) - len(kept), (b"\0" + bytes(gone)).count(b"\0\1"), sha(kept))
    return out


def decontaminated(docs, items, width=10):
    wins = defaultdict(set)
    for i, text in items:
        w = BENCH_WORDS.findall((text or "").translate(LOWER))
        for p in range(max(1, len(w) - width + 1) if w else 0):
            wins[tuple(w[p : p + width])].add(str(i))
    out = {}
    for i, text in docs:
        w = BENCH_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(g) for g in wins}:
            for p in range(len(w) - n + 1):
                if g := wins.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    found |= g
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def top_k(rows, queries, k=20):
    out = []
    for q, v in rows:
        if q in queries:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def spans(text):
    """The fixed patterns by the regular expressions as they are stated."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def merkle(docs):
    """docs: (doc_id, source, lang, n_chars, text); one result per row, sorted."""
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: sha("".join(map(said, (r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]))))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def climb(levels, i, h, proof):
        for level in levels[:-1]:
            run = level[i // 2 * 2 : i // 2 * 2 + 2]
            proof += [x for j, x in enumerate(run) if j != i % 2]
            run[i % 2] = h
            h, i = sha("".join(run)), i // 2
        return h

    by_lang = defaultdict(list)
    for r in docs:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    rows = [sorted(by_lang[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs]
    trees = [tree([leaf(r) for r in part]) for part in rows]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, part in enumerate(rows):
        for i, r in enumerate(part):
            odd, proof = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0, []
            h = climb(top, k, climb(trees[k], i, leaf(r, int(odd)), proof), proof)
            out.append((r[0], trees[k][0][i], trees[k][-1][0], top[-1][0], sha("".join(proof)), h, h == top[-1][0]))
    return sorted(out, key=str)


def collocations(docs, least, words=5, top=2000):
    """docs: (lang, text)."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, words + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in often.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in often.items()):
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, x, y, total[lang], -s) for n, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def license_places(text, phrases):
    """(words, sorted (start, label) of each phrase's places)."""
    w = BENCH_WORDS.findall((text or "").translate(LOWER))
    return len(w), sorted((i, lab) for lab, p in phrases for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
