"""Plain-Python forms of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def without_repeats(texts, size=35):
    """(words, removed, digest) of each text after removal of repeated windows."""
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in all_words for i in range(len(w) - size + 1))
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def grams(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def near_classes(rows, n=5):
    """{row index: (class id, links)} of (id, text) rows at a similarity of 0.8."""
    sets = [grams(t, n) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root, links = list(range(len(rows))), Counter()

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g] if j < i)
        for j, k in shared.items():
            if 5 * k >= 4 * (len(s) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return {i: (least[find(i)], links[i], find(i)) for i in range(len(rows))}


def late_lines(rows):
    """Texts of (id, text) rows without the lines similar to an earlier one.

    A line is the set of its words, a repeated word with the number of its
    occurrence. Rows of equal id and text are one document.
    """
    def numbered(line):
        seen = Counter()
        out = set()
        for w in words(line):
            seen[w] += 1
            out.add((w, seen[w]))
        return out

    lines = []
    for i, (d, t) in enumerate(rows):
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            s = numbered(line)
            if s:
                key = (-1 if d is None else d, k)
                lines.append((key, i, k, s))
    gone = defaultdict(set)
    for key, i, k, s in lines:
        for other, _, _, r in lines:
            if other < key and 5 * len(s & r) >= 4 * len(s | r):
                gone[i].add(k)
                break
    out = []
    for i, (_, t) in enumerate(rows):
        out.append(None if t is None else
                   "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]))
    return out


def damaged(rows):
    """(conv_id, turn, role, text, present) of (conv_id, turn, role, text) rows, harmed by crc."""
    out = []
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv_id, turn, role, text, fault != 0)] * (2 if fault == 3 else 1)
    return out


def repaired(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest, turns)}."""
    groups = defaultdict(list)
    for conv_id, turn, role, text, present in rows:
        groups[conv_id] += [(turn is not None, turn or 0, role, text)] if present else []
    return {c: _repaired(sorted(g)) for c, g in groups.items()}


def _repaired(rows):
    blank = duplicate = truncated = illegal = 0
    seen, kinds = set(), []
    for _, _, role, text in rows:
        last = re.sub("[\x20\x09-\x0D]", "", text)[-1:]
        kind = "gone"
        if not last:
            blank += 1
        elif (role, text) in seen:
            duplicate += 1
        elif last not in ".!?":
            truncated += 1
            kind = "cut"
        else:
            kind = "whole"
        seen.add((role, text))
        kinds.append(kind)
    for one, two in zip(rows, rows[1:]):
        illegal += one[2][:1] + two[2][:1] not in ("su", "ua", "au")
    turns = {r[1] for r in rows if r[0]}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    # legal prefixes of (s?(ua)+)? : "" -> "s" -> "u" -> "a" -> "u"
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    after = {s: (0, "", ()) if s in ("", "a") else None for s in ("", "s", "u", "a")}
    for i in range(len(rows), -1, -1):
        here = {}
        for inserts in range(4):       # fewer inserts first, each round adds one before
            for state in ("", "s", "u", "a"):
                ways = [here[state]] if state in here else []
                if i == len(rows):
                    ways += [after[state]]
                else:
                    _, _, role, text = rows[i]

                    def way(cost, letter, new, turn):
                        rest = after.get(new)
                        if rest is not None:
                            ways.append((cost + rest[0], letter + rest[1], turn + rest[2]))

                    way(2, "D", state, ())
                    if kinds[i] != "gone":
                        extra = 5 * (kinds[i] == "cut")
                        new = goes.get((state, role[:1]))
                        if new:
                            way(extra, "K", new, ((role, text),))
                        for name in ("user", "assistant"):
                            new = goes.get((state, name[0]))
                            if new:
                                way(1 + extra, "R", new, ((name, text),))
                for name in ("user", "assistant"):
                    rest = here.get(goes.get((state, name[0])))
                    if rest is not None:
                        ways.append((5 + rest[0], "I" + rest[1], ((name, ""),) + rest[2]))
                ways = [w for w in ways if w is not None]
                if ways:
                    here[state] = min(ways)
        after = here
    cost, audit, turns = after[""]
    body = "\n".join(f"{r}:{t}" for r, t in turns)
    return (gaps, blank, duplicate, truncated, illegal, cost, audit,
            hashlib.sha256(body.encode()).hexdigest(), turns)


def piecewise(text):
    """Fingerprint of a text, byte by byte with Python's integers."""
    mask, mix, mix2 = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    hashes, window = [], 0
    for byte in (text or "").encode():
        window = window >> 8 | byte << 56
        h = window * mix & mask
        h ^= h >> 32
        hashes.append(h * mix2 & mask)

    def signature(level):
        codes, total, open_ = [], 0, False
        for h in hashes:
            total = (total + ((h ^ h >> 29) * mix)) & mask
            open_ = True
            if h < 1 << 64 - level:
                codes.append(total)
                total, open_ = 0, False
        if open_:
            codes.append(total)
        codes = [(c * mix2 & mask) >> 52 for c in codes]
        return "".join(letters[c >> 6] + letters[c & 63] for c in codes)

    level = 2
    while len(signature(level)) > 2 * 64:
        level += 1
    return f"{level}:{signature(level)}:{signature(level + 1)}"


def likeness(one, other):
    if one == other:
        return 1.0
    one, other = one.split(":"), other.split(":")
    best = 0.0
    for k, a in ((int(one[0]), one[1]), (int(one[0]) + 1, one[2])):
        for m, b in ((int(other[0]), other[1]), (int(other[0]) + 1, other[2])):
            if k == m and a and b:
                a_, b_ = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
                row = list(range(len(b_) + 1))       # edit distance without replacement
                for i, x in enumerate(a_, 1):
                    row, old = [i], row
                    for j, y in enumerate(b_, 1):
                        row.append(old[j - 1] if x == y else 1 + min(old[j], row[-1]))
                best = max(best, 1 - row[-1] / (len(a_) + len(b_)))
    return best


def with_next(rows):
    """Results of (doc_id, text) rows of different ids."""
    rows = sorted(((d is not None, d or 0, t or "") for d, t in rows))
    out = []
    for i, (known, d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][2]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        mark = piecewise(text)
        out.append((d if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    mark, piecewise(edited), likeness(mark, piecewise(edited)),
                    likeness(mark, piecewise(after))))
    return out


def merkle(rows):
    """Manifest rows of (doc_id, source, lang, n_chars, text) rows."""
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(row):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def up(nodes):
        """(root, one list of (left, right) per node)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for path, i in zip(paths, at):
                first = i // 16 * 16
                path.append((nodes[first:i], nodes[i + 1:first + 16]))
            at = [i // 16 for i in at]
            nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        return nodes[0], paths

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
             for s in names}
    subs = {s: up([leaf(r) for r in trees[s]]) for s in names}
    root, tops = up([subs[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for row, path in zip(trees[s], subs[s][1]):
            path = path + top
            d, text = row[0], row[4]
            changed = row
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None:
                changed = (*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), text))
            node = leaf(changed)
            for left, right in path:
                node = h(*left, node, *right)
            out.append((d, leaf(row), subs[s][0], root,
                        h(*(x for left, right in path for x in left + right)), node,
                        node == root))
    return out
