"""Plain versions of the contracts, one text at a time, for small fixtures."""

import hashlib
import re
import zlib

import numpy as np

LATE = 1 << 62


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n):
    w = words(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def groups(rows, n=3, num=90, den=100):
    """(doc_id, size, component) of each row."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * den >= max(len(a), len(b)) * num:
                same = len(a & b)
                if den * same >= num * (len(a) + len(b) - same):
                    parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if sets[i] and k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, len(sets[i]), least.get(find(i), k) if sets[i] else k) for i, (k, _) in enumerate(rows)]


def repeated_words(rows, window=13):
    first = {}
    all_words = [words(t) for _, t in rows]
    for (k, _), w in zip(rows, all_words, strict=True):
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            first[s] = min(first.get(s, LATE), LATE if k is None else k)
    out = []
    for (k, _), w in zip(rows, all_words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (LATE if k is None else k):
                gone[i : i + window] = [True] * window
        out.append((k, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def repeated_bytes(rows, window=200):
    count = {}
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        for i in range(len(b) - window + 1):
            s = hash(b[i : i + window])
            count[s] = count.get(s, 0) + 1
    out = []
    for (k, _), b in zip(rows, data, strict=True):
        delta = np.zeros(len(b) + 1, int)
        for i in range(len(b) - window + 1):
            if count[hash(b[i : i + window])] > 1:
                delta[i] += 1
                delta[i + window] -= 1
        gone = np.cumsum(delta[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((k, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


def hits(rows, items, window=13):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = pattern.findall(ascii_lower(t or ""))
        for at in range(max(1, len(w) - window + 1)) if w else []:
            windows.setdefault(tuple(w[at : at + window]), set()).add(None if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for k, t in rows:
        w = pattern.findall(ascii_lower(t or ""))
        hit, found = [False] * len(w), set()
        for at in range(len(w)):
            for n in sizes:
                s = tuple(w[at : at + n])
                if len(s) == n and s in windows:
                    found |= windows[s]
                    hit[at : at + n] = [True] * n
        n_hit = sum(hit)
        out.append((k, len(w), n_hit, len(found), sha(",".join(sorted(found - {None}))), n_hit > 0 and 20 * n_hit >= len(w)))
    return out


SECRETS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def secrets(text):
    found = [(m.start(), i, kind, m.end()) for i, (kind, p, keep) in enumerate(SECRETS) for m in p.finditer(text or "") if keep(m)]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def redacted(text):
    out, at = "", 0
    for a, b in sorted((a, b) for _, a, b in secrets(text)):
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_digits(m)) <= 15),
)


def personal(text):
    return [(kind, m.start(), m.end()) for kind, p, keep in PERSONAL for m in re.finditer(p, text or "") if keep(m[0])]


def spans(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def pieces(ids, capacity=4096):
    ids = [*ids, 1]
    for n, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        yield n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def fill_in_middle(rows, seed=7, percent=100, spm=50):
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row."""
    out = []
    for k, t in rows:
        t = t or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        digest = sha(f"{seed}:{'' if k is None else k}")
        h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
            out.append((k, len(units), "plain", None, None, t))
        elif h[3] % 100 < spm:
            out.append((k, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((k, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return out


def row_hash(*values):
    """Spark's 64-bit hash of a row: each value is hashed with the hash before it as seed."""
    import struct

    import xxhash

    h = 42
    for kind, v in values:
        if v is not None:
            data = v.encode() if kind == "s" else struct.pack("<i" if kind == "i" else "<q", v)
            h = xxhash.xxh64_intdigest(data, seed=h)
    return h - (1 << 64) if h >> 63 else h


def mixture(rows, block, shards, seed=7, most=3):
    """(doc_id, source, size, target, {(shard, epoch, start, words)}) of each (doc_id, text, source)."""
    from sheetflow.llm.mixing import ROUNDS, split_quotas

    names = sorted({r[2] for r in rows}, key=lambda x: (x is None, x or ""))
    sized = [(row_hash(("i", seed), ("s", None if k is None else str(k)), ("s", t or "")), -1 if k is None else k, len(words(t)), i) for i, (k, t, _) in enumerate(rows)]
    total = {n: sum(s[2] for s, r in zip(sized, rows, strict=True) if r[2] == n) for n in names}
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    capped = {n for n in names if not total[n]}
    while len(capped) < len(names):
        left = sum(total.values()) - sum(most * total[n] for n in capped)
        unit = left / sum(weight[n] for n in names if n not in capped)
        for n in names:
            target[n] = float(most * total[n]) if n in capped else unit * weight[n]
        above = {n for n in names if n not in capped and target[n] > most * total[n]}
        if not above:
            break
        capped |= above

    def permuted(x, n, no, epoch):
        for r in range(1, ROUNDS + 1):
            y = (row_hash(("i", seed), ("i", no), ("q", epoch), ("i", r)) % n - x) % n
            if row_hash(("i", seed), ("i", no), ("q", epoch), ("i", r), ("q", max(x, y))) & 1:
                x = y
        return x

    quota, taken = [], [set() for _ in rows]
    for n in names:
        want = min(round(target[n]), most * total[n])
        full, rest = divmod(want, total[n]) if total[n] else (0, 0)
        quota.append(full * -(-total[n] // block) + -(-rest // block))
    cuts = [(shard, before, own) for shard, before, own in split_quotas(np.array(quota), shards, seed, 0, shards)]
    for no, n in enumerate(names):
        if not total[n]:
            continue
        want = min(round(target[n]), most * total[n])
        full, rest = divmod(want, total[n])
        stream = [(i, w) for *_, size, i in sorted(s for s in sized if rows[s[3]][2] == n) for w in range(size)]
        blocks = [stream[i : i + block] for i in range(0, len(stream), block)]
        whole = total[n] // block
        for epoch in range(full + (rest > 0)):
            for j, b in enumerate(blocks):
                nth = permuted(j, whole, no, epoch) if j < whole else whole
                b = b if epoch < full else b[: max(0, rest - nth * block)]
                spot = epoch * len(blocks) + nth
                shard = next((s for s, before, own in cuts if before[no] <= spot < before[no] + own[no]), None)
                for i in {i for i, _ in b}:
                    at = [w for x, w in b if x == i]
                    taken[i].add((shard, epoch, at[0], len(at)))
    return [(k, s, sized[i][2], target[s], frozenset(taken[i])) for i, (k, _, s) in enumerate(rows)]


BLANKS = " \t\n\x0b\f\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(shown.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(turns):
    seen, out = set(), []
    for turn in turns:
        bare = turn[1].rstrip(BLANKS)
        out.append("blank" if not bare else "duplicate" if turn in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add(turn)
    return out


def repaired(turns):
    """(cost, audit, turns) of the cheapest repair, place by place."""
    named = {"u": "user", "a": "assistant"}

    def put(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def with_inserts(table):
        for _ in range(4):
            for q, (c, a, o) in list(table.items()):
                for r, name in named.items():
                    if (q, r) in NEXT:
                        put(table, NEXT[q, r], (c + 3, a + "I", (*o, (name, ""))))
        return table

    best = {0: (0, "", ())}
    for (role, text), fault in zip(turns, faults(turns), strict=True):
        after = {}
        for q, (c, a, o) in with_inserts(best).items():
            put(after, q, (c + 4, a + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            if (q, role[:1]) in NEXT:
                put(after, NEXT[q, role[:1]], (c + more, a + "K", (*o, (role, text))))
            for r, name in named.items():
                if (q, r) in NEXT:
                    put(after, NEXT[q, r], (c + 3 + more, a + "R", (*o, (name, text))))
        best = after
    return min(v for q, v in with_inserts(best).items() if q in (0, 3))


def conversations(rows):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns) of each conversation with rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)))
    out = []
    for conv, group in groups.items():
        order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5("\0".join([str(r[1] is None).lower(), str("" if r[1] is None else r[1]), *r[2:]]).encode()).hexdigest())
        group.sort(key=order)
        numbers = [r[1] for r in group if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        found = faults([r[2:] for r in group])
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(group, group[1:]))
        out.append((conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *repaired([r[2:] for r in group])))
    return out
