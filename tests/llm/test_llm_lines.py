import re
from collections import Counter, defaultdict

from brute import TEXTS

from tidemark.llm import line_templates as lt
from tidemark.llm import store

SCHEMA = "doc_id long, text string"


def _brute(rows):
    """(doc_id, n_lines, n_dropped, text) for each row."""

    def tokens(line):
        return ["<*>" if re.search("[0-9]", t) else t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]

    texts = defaultdict(set)
    for _, text in rows:
        for line in (text or "").split("\n"):
            if len(tokens(line)) >= 4:
                texts[line].add(text)
    groups = defaultdict(list)
    for line in texts:
        groups[len(tokens(line)), *tokens(line)[:3]].append(line)
    template = {}
    for level in range(3):
        after = defaultdict(list)
        for name, lines in groups.items():
            at = [Counter(x) for x in zip(*map(tokens, lines))]
            most = [max(c, key=lambda t: (c[t], t)) for c in at]
            constant = [2 * c[t] > len(lines) and t != "<*>" for c, t in zip(at, most)]
            differ = [(len(c), i) for i, c in enumerate(at) if len(c) > 1]
            for line in lines:
                own = tokens(line)
                hits = sum(k and a == b for k, a, b in zip(constant, own, most))
                if hits >= 0.6 * len(own):
                    template[line] = (level, name)
                else:
                    after[name, own[min(differ)[1]] if differ else None].append(line)
        groups = after
    recurs = defaultdict(set)
    for line, t in template.items():
        recurs[t] |= texts[line]
    gone = {line for line, t in template.items() if len(recurs[t]) >= 5}
    gone |= {line for line, found in texts.items() if len(found) >= 2}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if line not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def _rows():
    rows = list(TEXTS)
    for i in range(12):
        own = f"only in {'abcdefghijkl'[i]} there is this line"
        rows.append((100 + i, f"User u{i} logged in at {i}:00\n{own}\n\nRead more about it here\n{own}"))
    rows += [(200, rows[-1][1])] * 3  # copies are one text
    rows += [(300 + i, f"Some rare words here {i}") for i in range(4)]
    rows += [(400, "\n".join(f"Item {i} in this one text" for i in range(40)))]
    return rows


def _found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    rows = _rows()
    got = _found(lt.drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)))
    assert got == _brute(rows)
    dropped = {r[0]: r[2] for r in got}
    assert dropped[100] == 2 and dropped[300] == 0 and dropped[400] == 0


def test_a_variable_field_is_found_among_few_and_many(spark):
    """The same line with two fields, one a text: all go, whether there are 10**2 or 10**5."""
    names = "concat('n', translate(cast(id % {} as string), '0123456789', 'abcdefghij'))"
    for n, kinds in ((100, 50), (100_000, 2000)):
        line = f"concat('This page was written by ', {names.format(kinds)}, ' from ', {names.format(kinds + 7)}, ' for our readers')"
        own = f"concat('own words of ', {names.format(n)}, ' and ', {names.format(n)}, ' ', {names.format(n)})"
        docs = spark.range(n).selectExpr("id AS doc_id", f"concat({line}, '\n', {own}) AS text")
        got = lt.drop_recurring_lines(docs).groupBy("n_dropped").count().collect()
        assert [r["count"] for r in got if r["n_dropped"] > 0] == [n]


def test_lines_that_vary_at_different_places_share_a_template(spark):
    words = "Read all the news of {} with {} and {} on our pages".split()
    rows = []
    for i in range(12):
        fields = ["sport", "film", "art"]
        fields[i % 3] = f"thing{'abcdefghijkl'[i]}"
        rows.append((i, " ".join(words).format(*fields) + "\nalone " + "xyz"[i % 3] * (i + 1) + " x y z"))
    got = _found(lt.drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)))
    assert got == _brute(rows) and all(r[2] >= 1 for r in got)


def test_a_long_line_in_two_texts_goes(spark):
    line = " ".join(f"word{'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(60))
    rows = [(1, line + "\nfirst one of all"), (2, "other one of these\n" + line), (3, "a third one here")]
    got = _found(lt.drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)))
    assert got == _brute(rows) and [r[2] for r in got] == [1, 1, 0]


def test_columns_and_empty_table(spark):
    rows = [("_line", t, i) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "_k1 string, text string, doc_id long")
    got = lt.drop_recurring_lines(docs)
    assert got.columns == ["_k1", "text", "doc_id", "n_lines", "n_dropped"]
    assert _found(got) == _brute(TEXTS)
    assert lt.drop_recurring_lines(docs.limit(0)).count() == 0


def test_only_lines_of_wanted_leaves_are_looked_at(spark, monkeypatch):
    """However crowded the buckets of the filters are, and copies of a text count as one."""
    rows = _rows() + [(500 + i, f"Copied words of one\nCopied words of one text {i // 9}") for i in range(9)]
    sizes = {}

    def stored(df, label, *args):
        out = store.stored(df, label, *args)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(store, "FILTER_BUCKETS", 1)
    monkeypatch.setattr(lt, "stored", stored)
    got = _found(lt.drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)))
    assert got == _brute(rows)
    assert sizes["different-lines"] == sizes["alike-lines"] < sizes["lines-seen"]
