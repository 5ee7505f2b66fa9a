"""Plain single-process versions of what the operators compute."""

import hashlib
import re
import zlib


def decontam(docs, bench, width=10):
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: rx.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for item, text in bench:
        w = low(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = low(text)
        hit, items = set(), set()
        for i in range(len(w)):
            for n in sizes:
                key = tuple(w[i : i + n])
                if len(key) == n and key in windows:
                    hit.update(range(i, i + n))
                    items |= windows[key]
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


def simhash(text):
    import xxhash

    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius=3):
    """{doc: smallest doc linked} by comparing all pairs."""
    ids = [d for d, _ in prints]
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, (a, fa) in enumerate(prints):
        for b, fb in prints[:i]:
            if (fa ^ fb).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def tokens(docs, path):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    out, start = [], 0
    for doc, text in sorted(docs):
        ids = [*tk.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out
