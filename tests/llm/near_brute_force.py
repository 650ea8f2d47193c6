"""Holds op6 against brute force over all documents of a folder: python -m tests.llm.near_brute_force FOLDER

Every pair that shares a shingle is counted through postings, so no candidate search is trusted. Run by hand: a minute or more.
"""

import collections
import re
import sys
import time

import numpy as np

BREAK = re.compile(r"[\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    """{doc_id: (number of shingles, smallest id reachable)}"""
    number, sets = {}, []
    for _, text in rows:
        w = [x for x in BREAK.split((text or "").translate(LOWER)) if x]
        grams = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        sets.append(np.array(sorted(number.setdefault(g, len(number)) for g in grams), np.int64))
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    start = np.searchsorted(every[order], np.arange(len(number) + 1))
    owners = owner[order]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = {}
    for i, s in enumerate(sets):
        if len(s):
            k = first.setdefault(s.tobytes(), i)
            if k != i:  # equal sets are linked; the first speaks for them
                parent[root(i)] = root(k)
    links = 0
    for i in first.values():
        met = np.concatenate([owners[start[g] : start[g + 1]] for g in sets[i]])
        shared = np.bincount(met[met < i], minlength=0)
        for j in np.flatnonzero(100 * shared >= 75 * (size[i] + size[: len(shared)] - shared)):
            if shared[j]:
                links += 1
                parent[root(i)] = root(int(j))
    least = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    return {doc_id: (int(size[i]), min(least[root(i)])) for i, (doc_id, _) in enumerate(rows)}, links


def main(folder):
    import tempfile

    from pyspark.sql import SparkSession

    from bookaudit.llm.near_dedup import op6_setsketch

    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-near-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    began = time.time()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op6_setsketch(spark, folder).collect()}
    took = time.time() - began
    want, links = expected([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()])
    wrong = [i for i in want if got.get(i) != want[i]]
    print(f"{len(want)} documents, {links} links of different sets, {len({c for _, c in want.values()})} classes, {len(wrong)} wrong rows, {took:.0f} s", wrong[:5])


if __name__ == "__main__":
    main(sys.argv[1])
