"""Shared rules of the contracts, written plainly."""

import re

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    """Plain union-find."""

    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def words(text):
    return WORDS.findall(text or "")


def table(sf, name):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()
