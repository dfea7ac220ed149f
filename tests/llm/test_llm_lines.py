from __future__ import annotations

from collections import defaultdict

from helpers import awkward, documents

from tabulark.llm.lines import drop_common_lines

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, chars=40, least=5):
    holders = defaultdict(set)

    def key(line):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))
        return low if len(low) >= chars else None

    for doc, text in rows:
        for line in (text or "").split("\n"):
            if key(line) is not None:
                holders[key(line)].add(doc)
    shared = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items() if len(v) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in shared or shared[key(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_shared_lines(spark, widths):
    line = "THIS line is long enough to be judged by its key"
    other = "ünïcode line that is found in exactly four of these documents"
    rows = [(i, f"start {i}\n  {line.lower()}\t\nend\n{line}") for i in range(6)]
    rows += [(i, other + "\n\n") for i in range(20, 24)] + [(30, line), (None, line), (31, "x" * 39)]
    rows += awkward(500) + [(40, line), (40, line + "\nown")]
    assert found(drop_common_lines(documents(spark, rows))) == brute([r[:2] for r in rows])


def test_columns_stay_and_empty_table(spark):
    docs = documents(spark, [(1, "a", "en", "s")])
    out = drop_common_lines(docs)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    assert out.first()["n_lines"] == 1 and out.first()["key"] == 7
    assert drop_common_lines(docs.limit(0)).count() == 0


def test_a_line_in_most_documents(spark):
    line = "one line of license text that nearly every document carries"
    rows = [(i, f"{line}\nbody {i}") for i in range(400)]
    assert found(drop_common_lines(documents(spark, rows))) == brute(rows)
