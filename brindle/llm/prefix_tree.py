"""A prefix tree of ordered token sets, and the links of its sets by similarity.

Tokens get ranks by how many of the sets hold them, most first, so similar sets share long paths; paths without a branch
are one node. A set is sought by walking the tree once: what a shared path has in common with it is counted once
for all sets below, and a branch is left when not even its largest set could still reach the similarity,
given the tokens missed on either side so far (remaining-length bounds).

A node with many children is not walked child by child: an index says which children hold a token of the set in their own
part of the path, and of the others, which share nothing there, those that pass the bound are a prefix in the order of what the bound asks. So children that
neither share a token nor need one are never looked at, however many there are. Where bounds prune little (sets that differ from each other all along their
paths), a walk that has cost as much as one pass over the tree is given up for that pass: the overlaps of all paths with the set, each shared part counted once.

links() leaves branches whose sets all are in the seeking set's component already: enough links are found to join what is linked, not all of
them. degrees() counts all links: only bounds prune.
"""

from __future__ import annotations

import numpy as np

MANY = 16  # children from which on they are indexed
STEP = 3000  # what a step of a walk costs, in tokens of a pass


class _Index:
    """The children of a node: who holds which token, and what the bound asks of each if none is held."""

    def __init__(self, tree: Tree, x: int):
        kids = tree.kids[x]
        self.kids = np.array(kids)
        parts = [tree.rows[o][s:e] for o, s, e in (tree.seg[c] for c in kids)]
        flat = np.concatenate(parts)
        owner = np.repeat(np.arange(len(kids)), [len(p) for p in parts])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(flat)) + 1, [len(flat)]))
        self.holders = {int(flat[a]): owner[a:b] for a, b in zip(cuts, cuts[1:])}
        self.end = np.array([tree.seg[c][2] for c in kids])
        self.last = np.array([p[-1] for p in parts])
        self.largest = np.array([tree.largest[c] for c in kids])
        asks = tree.both * self.end - tree.den * self.largest
        self.order = np.argsort(asks, kind="stable")
        self.asks = asks[self.order]


class Tree:
    def __init__(self, rows: list[np.ndarray], which, num: int, den: int):
        self.rows, self.num, self.den, self.both = rows, num, den, num + den
        self.size = [len(r) for r in rows]
        self.order, self.root, self.seg, self.kids, self.ends = _tree(rows, which)
        below = [self.root]
        for x in below:
            below.extend(self.kids[x])
        at = {k: n for n, k in enumerate(self.order)}
        many = len(self.seg)
        self.largest, self.low, self.high = [0] * many, [0] * many, [0] * many  # of a node: greatest size below, and its sets in order
        for x in reversed(below):
            self.largest[x] = max([self.size[k] for k in self.ends[x]] + [self.largest[c] for c in self.kids[x]])
            self.low[x] = min([at[k] for k in self.ends[x]] + [self.low[c] for c in self.kids[x]])
            self.high[x] = max([at[k] + 1 for k in self.ends[x]] + [self.high[c] for c in self.kids[x]])
        self.indexes: dict[int, _Index] = {}
        self._flat = None
        self.spent, self.most = 0, sum(e - s for _, s, e in self.seg) + 4 * many
        self.budget = self.most

    def begin(self) -> None:
        self.spent = 0

    def walked(self, kids) -> bool:
        """Whether the walk may go on; one that was given up halves what the next may cost, one that was not doubles it."""
        self.spent += STEP + 20 * len(kids)
        if self.spent > max(self.budget, 4 * STEP):
            self.budget //= 2
            return False
        return True

    def ended(self) -> None:
        self.budget = min(self.most, 2 * self.budget + STEP)

    def overlaps(self, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tree's sets, and what each has in common with the marked tokens: one pass over all paths."""
        if self._flat is None:
            # a node is entered and left: between, its segment's overlap is on the path
            who, where, events, signs = [], [], [], []
            stack = [(self.root, False)]
            while stack:
                x, leave = stack.pop()
                events.append(x)
                signs.append(-1 if leave else 1)
                if not leave:
                    who += self.ends[x]
                    where += [len(events) - 1] * len(self.ends[x])
                    stack.append((x, True))
                    stack.extend((c, False) for c in self.kids[x])
            flat = np.concatenate([self.rows[o][s:e] for o, s, e in self.seg])
            at = np.cumsum([0, *[e - s for _, s, e in self.seg]])
            self._flat = flat, at, np.array(events), np.array(signs), np.array(who), np.array(where), np.zeros(len(flat) + 1, np.int64)
        flat, at, events, signs, who, where, sums = self._flat
        np.cumsum(mark[flat], out=sums[1:])
        own = sums[at[1:]] - sums[at[:-1]]
        return who, np.cumsum(own[events] * signs)[where]

    def passing(self, x: int, overlap: int, row: np.ndarray, mark: np.ndarray) -> tuple:
        """The children of x that may hold a set similar to row (mark: its tokens), and what each child's whole path has in common with it."""
        num, both, a = self.num, self.both, len(row)
        if len(self.kids[x]) < MANY:
            out, common = [], []
            for c in self.kids[x]:
                owner, s, e = self.seg[c]
                path = self.rows[owner][s:e]
                o = overlap + int(np.count_nonzero(mark[path]))
                best = self.largest[c]
                # tokens of the path that are missed bind the largest set below most, those of the seeker the smallest
                if (best - (e - o)) * both >= num * (a + best) and (a - (int(row.searchsorted(path[-1], "right")) - o)) * both >= num * (a + e):
                    out.append(c)
                    common.append(o)
            return out, common
        index = self.indexes.get(x)
        if index is None:
            index = self.indexes[x] = _Index(self, x)
        # who shares nothing here passes by what it asks alone: (largest - end + overlap) * both >= num * (a + largest)
        idle = index.order[: int(np.searchsorted(index.asks, overlap * both - num * a, "right"))]
        held = [h for h in map(index.holders.get, row.tolist()) if h is not None]
        if held:
            who, more = np.unique(np.concatenate(held), return_counts=True)
            if len(idle):
                new = np.ones(len(index.kids), bool)
                new[who] = False
                idle = idle[new[idle]]
            who, common = np.concatenate((who, idle)), np.concatenate((more, np.zeros(len(idle), np.int64))) + overlap
        else:
            who, common = idle, np.full(len(idle), overlap)
        if not len(who):
            return (), ()
        best, e = index.largest[who], index.end[who]
        fits = ((best - (e - common)) * both >= num * (a + best)) & ((a - (row.searchsorted(index.last[who], "right") - common)) * both >= num * (a + e))
        return index.kids[who[fits]], common[fits]


def links(sets: list[np.ndarray], num: int, den: int, labels: list[int] | None = None, seek: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs of places that link sets of similarity num/den or more, so that sets linked in any way are joined.

    sets: distinct uint64 each, not empty. labels: components known before (equal label: joined). seek: the places whose
    links count (all by default); links between two others are not looked for.
    """
    n = len(sets)
    if n < 2:
        return []
    rows, distinct = _ranked(sets)
    tree = Tree(rows, range(n), num, den)
    at = np.empty(n, np.int64)  # places in the tree's order: the sets below a node are a range
    at[tree.order] = np.arange(n)
    group = (np.arange(n) if labels is None else np.unique(np.array(labels), return_inverse=True)[1])[tree.order]
    uniform, seen, joins = np.zeros(len(tree.seg), bool), [-1] * len(tree.seg), 0
    low = np.array(tree.low)
    size = np.array(tree.size)
    mark = np.zeros(distinct, bool)
    found = []

    def join(k: int, other: int) -> None:
        nonlocal joins
        group[group == group[at[other]]] = group[at[k]]
        joins += 1
        found.append((k, other))

    for k in seek if seek is not None else tree.order:
        row, mine = rows[k], int(at[k])
        mark[row] = True
        stack = [(tree.root, 0)]
        tree.begin()
        while stack:
            x, overlap = stack.pop()
            if not uniform[x] and seen[x] != joins:
                part = group[tree.low[x] : tree.high[x]]
                uniform[x], seen[x] = bool((part == part[0]).all()), joins
            if uniform[x] and group[low[x]] == group[mine]:
                continue
            for other in tree.ends[x]:
                if other != k and group[at[other]] != group[mine] and overlap * tree.both >= num * (len(row) + tree.size[other]):
                    join(k, other)
            kids, common = tree.passing(x, overlap, row, mark)
            if not tree.walked(kids):
                who, all_common = tree.overlaps(mark)
                for other in who[all_common * tree.both >= num * (len(row) + size[who])].tolist():
                    if group[at[other]] != group[mine]:
                        join(k, other)
                break
            if len(kids) >= MANY:
                new = ~(uniform[kids] & (group[low[kids]] == group[mine]))
                kids, common = kids[new], common[new]
            stack.extend(zip(map(int, kids), map(int, common)))
        else:
            tree.ended()
        mark[row] = False
    return found


def _ranked(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The sets as ascending ranks, and the number of distinct tokens."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    ranked = rank[inverse]
    return [np.sort(ranked[a:b]) for a, b in zip(starts, starts[1:])], len(counts)


def _tree(rows: list[np.ndarray], which) -> tuple[list[int], int, list, list, list]:
    """The order of the sets `which`, the root, and for each node the segment of a set's ranks, the children, the sets that end there."""
    order = sorted(which, key=lambda k: rows[k].astype(">u4").tobytes())
    seg, kids, ends = [], [], []

    def node(k: int, a: int, b: int) -> int:
        seg.append((k, a, b))
        kids.append([])
        ends.append([])
        return len(seg) - 1

    root = node(order[0], 0, 0)
    path = [(root, 0)]  # nodes with the depth at which each ends
    before = None
    for k in order:
        row = rows[k]
        common = 0
        if before is not None:
            m = min(len(row), len(before))
            differ = np.flatnonzero(row[:m] != before[:m])
            common = int(differ[0]) if len(differ) else m
        while len(path) > 1 and path[-2][1] >= common:
            path.pop()
        at, depth = path[-1]
        if depth > common:  # the last node is cut in two
            owner, a, b = seg[at]
            cut = node(owner, common, b)
            kids[cut], kids[at] = kids[at], [cut]
            ends[cut], ends[at] = ends[at], []
            seg[at] = (owner, a, common)
            path[-1] = (at, common)
        if len(row) > common:
            new = node(k, common, len(row))
            kids[path[-1][0]].append(new)
            path.append((new, len(row)))
        ends[path[-1][0]].append(k)
        before = row
    return order, root, seg, kids, ends


def degrees(sets: list[np.ndarray], num: int, den: int, weights: list[int], seek: list[int] | None = None) -> list[int]:
    """For each place the sum of the weights of the other sets of similarity num/den or more.

    sets: distinct uint64 each, not empty. seek: if given, only links between these places and the others count.
    """
    out = np.zeros(len(sets), np.int64)
    held = range(len(sets)) if seek is None else sorted(set(range(len(sets))) - set(seek))
    if len(sets) < 2 or not len(held):
        return out.tolist()
    weight = np.asarray(weights, np.int64)
    rows, distinct = _ranked(sets)
    tree = Tree(rows, held, num, den)
    size = np.array(tree.size)
    # the one set of a node without children, or -1
    single = np.array([e[0] if len(e) == 1 and not kids else -1 for e, kids in zip(tree.ends, tree.kids, strict=True)])
    mark = np.zeros(distinct, bool)
    for k in tree.order if seek is None else seek:
        row, like = rows[k], []
        mark[row] = True
        stack = [(tree.root, 0)]
        tree.begin()
        while stack:
            x, overlap = stack.pop()
            like += [o for o in tree.ends[x] if o != k and overlap * tree.both >= num * (len(row) + tree.size[o])]
            kids, common = tree.passing(x, overlap, row, mark)
            if not tree.walked(kids):
                who, common = tree.overlaps(mark)
                like = who[(common * tree.both >= num * (len(row) + size[who])) & (who != k)]
                break
            if len(kids) >= MANY:
                leaf = single[kids]
                alone = leaf >= 0
                stack.extend(zip(kids[~alone].tolist(), common[~alone].tolist()))
                leaf, common = leaf[alone], common[alone]
                like += leaf[(common * tree.both >= num * (len(row) + size[leaf])) & (leaf != k)].tolist()
            else:
                stack.extend(zip(map(int, kids), map(int, common)))
        else:
            tree.ended()
        if len(like):
            out[k] += weight[like].sum()
            if seek is not None:
                out[like] += weight[k]
        mark[row] = False
    return out.tolist()
