"""BK-tree over 64-bit fingerprints: children keyed by integer Hamming distance to the parent."""

from __future__ import annotations


class BKTree:
    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def __len__(self) -> int:
        return len(self.values)

    def within(self, value: int, radius: int) -> list[int]:
        """Indexes of values at most ``radius`` away: only edges in [d - radius, d + radius] are followed."""
        if not self.values:
            return []
        values, children, found, stack = self.values, self.children, [], [0]
        while stack:
            at = stack.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            edges = children[at]
            if edges:
                low, high = d - radius, d + radius
                stack.extend([x for edge, x in edges.items() if low <= edge <= high])
        return found

    def add(self, value: int) -> int:
        """Index of the value, which is added unless it is there."""
        values, children = self.values, self.children
        if not values:
            values.append(value)
            children.append({})
            return 0
        at = 0
        while d := (values[at] ^ value).bit_count():
            following = children[at].get(d)
            if following is None:
                children[at][d] = len(values)
                values.append(value)
                children.append({})
                return len(values) - 1
            at = following
        return at


def forest_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join all values connected within the radius: at most len(values) - 1 of them."""
    tree, parent, links = BKTree(), [], []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in values:
        near = tree.within(value, radius)
        at = tree.add(value)
        if at == len(parent):
            parent.append(at)
        for other in near:
            a, b = top(at), top(other)
            if a != b:
                parent[a] = b
                links.append((value, tree.values[other]))
    return links
