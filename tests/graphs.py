"""Small typed graphs with known answers, and brute-force algorithms to compare with."""

from __future__ import annotations

import heapq
import itertools
import random
from collections import defaultdict, deque

SMALL_AIRPORTS = [
    ("MKE", "ORD", 66), ("ORD", "MKE", 66), ("ORD", "DEN", 886), ("DEN", "ORD", 886),
    ("SJC", "DEN", 948), ("DEN", "SJC", 948), ("SJC", "ORD", 1829),
]

_MORE = {"MSN": ("ORD", 135), "MSP": ("ORD", 334), "GRB": ("ORD", 196), "EGE": ("DEN", 155), "COS": ("DEN", 95),
         "PUB": ("DEN", 133), "ASE": ("DEN", 125), "FNL": ("DEN", 58)}
AIRPORTS = SMALL_AIRPORTS + [e for a, (b, d) in _MORE.items() for e in ((a, b, d), (b, a, d))]


def supply_chain():
    """Persons, orders, items, stores, distribution centres and reviewers: 24 nodes, 42 edges."""
    persons = [f"P_{i}" for i in range(101, 105)]
    orders = [f"O_{i}" for i in range(101, 109)]
    items = [f"I_{i}" for i in range(101, 105)]
    nodes = persons + orders + items + [f"S_{i}" for i in range(101, 105)] + ["D_101", "D_102", "R_101", "R_102"]
    edges = [(persons[i // 2], o) for i, o in enumerate(orders)]
    edges += [(o, "R_102" if o == "O_108" else "R_101") for o in orders]
    edges += [(o, items[i % 4]) for i, o in enumerate(orders)]
    stores = {"S_101": (1, 2, 3), "S_102": (2, 3), "S_103": (1, 2, 3), "S_104": (1, 2, 3, 4), "D_101": (1, 2, 3, 4), "D_102": (3, 4)}
    edges += [(f"I_10{i}", place) for place, held in stores.items() for i in held]
    return nodes, edges


def random_edges(nodes: int, edges: int, seed: int, hub_share: float = 0.0):
    """Directed edges with weights; a share of them leaves or enters node 0."""
    draw = random.Random(seed)
    out = []
    for _ in range(edges):
        a, b = draw.randrange(nodes), draw.randrange(nodes)
        if draw.random() < hub_share:
            a, b = (0, b) if draw.random() < 0.5 else (a, 0)
        out.append((a, b, draw.randrange(1, 20)))
    return out


def adjacency(edges, both=False):
    near = defaultdict(set)
    for a, b, *_ in edges:
        near[a].add(b)
        if both:
            near[b].add(a)
    return near


def distances(edges, source):
    near = defaultdict(dict)
    for a, b, w in edges:
        near[a][b] = min(w, near[a].get(b, w))
    best, queue = {}, [(0, source)]
    while queue:
        d, v = heapq.heappop(queue)
        if v in best:
            continue
        best[v] = d
        for u, w in near[v].items():
            heapq.heappush(queue, (d + w, u))
    return best


def components(nodes, edges):
    near, label = adjacency(edges, both=True), {}
    for start in sorted(nodes):
        if start in label:
            continue
        queue = deque([start])
        label[start] = start
        while queue:
            for u in near[queue.popleft()]:
                if u not in label:
                    label[u] = start
                    queue.append(u)
    return label


def betweenness(nodes, edges):
    near, total = adjacency([e for e in edges if e[0] != e[1]]), dict.fromkeys(nodes, 0.0)
    for s in nodes:
        order, parents, sigma, dist = [], defaultdict(list), defaultdict(float), {s: 0}
        sigma[s] = 1.0
        queue = deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    parents[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in parents[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                total[w] += delta[w]
    return total


def triangles(edges):
    near = adjacency([e for e in edges if e[0] != e[1]], both=True)
    return {t for a in near for b, c in itertools.combinations(sorted(near[a]), 2) if c in near[b] for t in [tuple(sorted((a, b, c)))]}


def core(nodes, edges, k):
    near = {n: set(x) - {n} for n, x in adjacency(edges, both=True).items()}
    while True:
        weak = [n for n in near if len(near[n]) < k]
        if not weak:
            return set(near)
        for n in weak:
            for u in near.pop(n):
                if u in near:
                    near[u].discard(n)


def simple_paths(edges, start, target, k, most_hops):
    light = {}
    for a, b, w in edges:
        light[a, b] = min(w, light.get((a, b), w))
    near = defaultdict(list)
    for (a, b), w in light.items():
        near[a].append((b, w))
    found, stack = [], [(0, [start])]
    while stack:
        cost, path = stack.pop()
        for b, w in near[path[-1]]:
            if b in path:
                continue
            if b == target:
                found.append((cost + w, ">".join(map(str, [*path, b]))))
            elif len(path) < most_hops:
                stack.append((cost + w, [*path, b]))
    return sorted(found)[:k]


def open_two_hops(edges):
    direct = {(a, b) for a, b, *_ in edges}
    count = defaultdict(int)
    for a, b, *_ in edges:
        for c, d, *_ in edges:
            if b == c and a != b and c != d and (a, d) not in direct:
                count[a, d] += 1
    return count
