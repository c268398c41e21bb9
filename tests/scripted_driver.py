"""A stand-in for a database driver: answers from the bound values alone and notes what it was sent. No database is behind it."""

import re

SENT = []


class Cursor:
    def execute(self, text, values):
        SENT.append((text, values))
        # Comparisons of "id" with bound values, over the numbers 0 to 99 and one null.
        tests = list(zip(re.findall(r"id (>=|<) \?", text), values))
        ids = [i for i in range(100) if all(i >= v if sign == ">=" else i < v for sign, v in tests)]
        others = re.sub(r"\([^()]*OR id IS NULL\)", "", text)
        null_passes = not re.search(r"id (>=|<) \?|IS NOT NULL", others)
        self.rows = [(i, f"n{i}") for i in ids] + [(None, "none")] * null_passes

    def fetchmany(self, n):
        out, self.rows = self.rows[:n], self.rows[n:]
        return out


class Connection:
    def __init__(self, url):
        assert url == "shop"

    def cursor(self):
        return Cursor()

    def close(self):
        SENT.append("closed")


def connect(url):
    return Connection(url)
