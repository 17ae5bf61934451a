"""Plain Python twins of the corpus operators, for small fixtures."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def similar_groups(rows, width=5, percent=75):
    """rows: (doc_id, text); returns sorted (doc_id, n_shingles, component_id)."""
    sets = [shingles(t, width) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen = set()
    for group in holders.values():
        for k, a in enumerate(group):
            for b in group[k + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def remove_repeats(rows, span=50):
    """rows: (doc_id, text); returns sorted (doc_id, n_words, n_removed, kept words)."""
    owner = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - span + 1):
            key = tuple(w[i:i + span])
            owner[key] = min(owner.get(key, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - span + 1):
            if owner[tuple(w[i:i + span])] < d:
                gone.update(range(i, i + span))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def trie(rows):
    """Nodes of the prefix trie over (conv_id, turn, role, text) rows with distinct turns, as a dict of tuples by (conv_id, depth)."""
    import hashlib
    import zlib
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, subtree = {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            at = subtree.setdefault(node[:d], [0, 0])
            at[0] += node not in children
            at[1] += saved
    out = []
    for node, convs in members.items():
        joined = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children.get(node, 0), *subtree[node],
                    hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def repaired(rows):
    """op11 by its rules: rows (conv_id, turn, role, text), edits by a search over audits in order of cost and letters."""
    import hashlib
    import heapq
    import re
    import zlib
    convs, out = {}, []
    for c, t, role, text in rows:
        mine = convs.setdefault(c, [])
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        mine += [((t is not None, t or 0), role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    follow = {0: "su", 1: "u", 2: "a", 3: "u"}
    state_of = {"s": 1, "u": 2, "a": 3}
    for c, mine in convs.items():
        mine.sort(key=lambda r: (r[0], r[1].encode(), r[2].encode()))
        seen, faults, turns = set(), [], [t for (known, t), _, _ in mine if known]
        for _, role, text in mine:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        first = [role[:1] for _, role, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        heap, done = [(0, "", 0, 0, ())], set()
        while True:
            cost, audit, i, state, lines = heapq.heappop(heap)
            if i == len(mine) and state in (0, 3):
                break
            if (i, state) in done:
                continue
            done.add((i, state))
            for r in follow[state]:
                if r != "s":
                    heapq.heappush(heap, (cost + 5, audit + "I", i, state_of[r], lines + ({"u": "user:", "a": "assistant:"}[r],)))
            if i < len(mine):
                _, role, text = mine[i]
                heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
                if faults[i] not in ("blank", "duplicate"):
                    more = 5 * (faults[i] == "truncated")
                    if first[i] and first[i] in follow[state]:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, state_of[first[i]], lines + (f"{role}:{text}",)))
                    for r in follow[state]:
                        if r != "s":
                            heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, state_of[r], lines + ({"u": "user:", "a": "assistant:"}[r] + text,)))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))
