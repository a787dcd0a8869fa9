"""Operators on documents against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import words
from publicspend.llm import line_cleaning, mixing, ngram_join, run_index, sanitise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def shingles(text):
    found = WORD.findall((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def components(rows, percent=80):
    """(doc_id, size, component) of each row, by comparing all with all."""
    sets = [shingles(text) for _, text, *_ in rows]
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            total = len(sets[i] | sets[j])
            if total and 100 * common >= percent * total:
                above[root(i)] = root(j)
    names = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            names[root(i)] = min(doc_id, names.get(root(i), doc_id))
    return sorted(
        (
            (r[0], len(sets[i]), names.get(root(i)) if sets[i] else r[0])
            for i, r in enumerate(rows)
        ),
        key=repr,
    )


def near_copies(rng):
    """Chains and stars of texts around the threshold, many that share passages, copies."""
    rows = []
    passage = [f"p{i}" for i in range(40)]
    for group in range(12):
        base = [f"g{group}w{rng.randrange(60)}" for _ in range(rng.choice([6, 30, 90]))]
        for _ in range(rng.randrange(2, 9)):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 20))):
                text[rng.randrange(len(text))] = f"m{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                text = passage + text
            rows.append((len(rows), " ".join(text)))
            base = text if rng.random() < 0.4 else base
    rows += [(len(rows) + i, " ".join(passage + [f"t{i}"])) for i in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rules", [{}, {"pairs": 1, "rounds": 2, "sketch_bits": 4, "broadcast_pairs": 0}, {"rounds": 1}])
def test_near_duplicates(spark, seed, rules):
    rows = near_copies(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = ngram_join.near_duplicates(docs, ngram_join.JoinRules(**rules))
    assert rows_of(found) == components(rows)


def test_near_duplicates_of_awkward_rows(spark, documents, awkward, no_documents):
    assert rows_of(ngram_join.near_duplicates(documents)) == components(awkward)
    assert ngram_join.near_duplicates(no_documents).count() == 0


def test_first_of_each_group(spark, documents, awkward):
    left = ngram_join.first_of_each_group(documents)
    assert left.columns == documents.columns
    kept = Counter((row.doc_id, row.text) for row in left.collect())
    groups = {}
    for (doc_id, _, group), (_, text, _) in zip(components_in_order(awkward), awkward, strict=True):
        if shingles(text):
            groups.setdefault(group, []).append((doc_id, text))
    for members in groups.values():
        assert sum(kept[m] for m in set(members)) == 1
    blank = [(i, t) for i, t, _ in awkward if not shingles(t)]
    assert all(kept[b] == 1 for b in blank)


def components_in_order(rows):
    """As ``components``, in the order of the rows; groups without an id by their text."""
    out = []
    for i, (doc_id, text, *_) in enumerate(rows):
        linked = {i}
        while True:
            more = {
                j
                for j in range(len(rows))
                for k in linked
                if shingles(rows[j][1])
                and 100 * len(shingles(rows[j][1]) & shingles(rows[k][1]))
                >= 80 * len(shingles(rows[j][1]) | shingles(rows[k][1]))
            }
            if more <= linked:
                break
            linked |= more
        out.append((doc_id, len(shingles(text)), min(linked)))
    return out


def test_prefix_filter_is_complete():
    """Linking sets share enough prefix tokens under every order, and the first one early."""
    import numpy as np

    rng, rules = np.random.default_rng(1), ngram_join.JoinRules()
    ranks = rng.integers(0, 4, 1 << rules.sketch_bits).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        base = rng.integers(0, 2**63, n + 15, dtype=np.uint64)
        x = np.unique(base[:n])
        y = np.unique(base[int(rng.integers(0, 8)) : n + int(rng.integers(0, 15))])
        if not len(x) or not len(y):
            continue
        common = len(np.intersect1d(x, y))
        if 100 * common < 80 * (len(x) + len(y) - common):
            continue
        for order in range(rules.orders):
            px, py = (
                ngram_join.in_order(s, ranks, rules.sketch_bits, order, rules.prefix(len(s)))
                for s in (x, y)
            )
            total, most = len(x) + len(y), max(len(x), len(y))
            need = -(-80 * total // 180) - -(-80 * most // 100) + 1
            assert len(np.intersect1d(px, py)) >= max(1, need)


def base_rules(text):
    found = WORD.findall(text or "")
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = set()
    for i in range(len(found) - 7):
        if windows[tuple(found[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_line_cleaning(spark, documents, awkward, no_documents):
    rng = random.Random(2)
    more = [
        (100 + i, "\n".join(rng.choice(["a b", "a b c d e f g h", "#x| y", ""]) for _ in range(9)), "s")
        for i in range(60)
    ]
    docs = documents.select("doc_id", "text").union(
        spark.createDataFrame(more, "doc_id bigint, text string, s string").select("doc_id", "text")
    )
    found = line_cleaning.clean_lines(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
    )
    expected = [(i, *base_rules(t)) for i, t, *_ in [*awkward, *more]]
    assert rows_of(found) == sorted(expected, key=repr)
    assert line_cleaning.clean_lines(no_documents).count() == 0


def test_lines_that_fail_go_and_take_documents_with_them(spark):
    prose = "\n".join(" ".join(f"word{i}{j}" for j in range(8)) + "." for i in range(8))
    menu = "Home | News | Sport | More\nLog in\nWe use cookies to improve things.\n"
    junk = "\n".join("Buy $$$ now!!! ### %%% *** &&& win" for _ in range(2)) + " ".join(f"{i}!!" for i in range(30))
    docs = spark.createDataFrame(
        [(1, prose, 1), (2, menu + prose, 1), (3, junk, 1)], "doc_id bigint, text string, n_chars int"
    )
    rows = {r.doc_id: r for r in line_cleaning.clean_lines(docs).collect()}
    assert rows[1].kept and rows[1].cleaned == prose
    assert rows[2].kept and rows[2].cleaned == prose
    assert (rows[2].n_nav_lines, rows[2].n_boiler_lines) == (2, 1)
    assert not rows[3].kept
    left = {r.doc_id: r for r in line_cleaning.cleaned_documents(docs).collect()}
    assert set(left) == {1, 2} and left[2].text == prose and left[2].n_chars == len(prose)


def removed(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for (doc_id, *_), x in zip(rows, texts, strict=True):
        cover = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(x, cover, strict=True) if not c)
        spans = len(re.findall(b"\1+", bytes(cover)))
        digest = hashlib.sha256(kept).hexdigest()
        out.append((doc_id, len(x), len(x) - len(kept), spans, digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rules", [{}, {"crowd": 1}, {"crowd": 1, "step": 7, "block": 500}])
def test_repeats(spark, documents, awkward, no_documents, rules):
    rules = run_index.RepeatRules(**rules)
    found = run_index.remove_repeats(documents, rules, with_kept=False)
    assert rows_of(found) == removed(awkward, 200)
    assert run_index.remove_repeats(no_documents).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeats_in_periodic_and_shuffled_text(spark, seed):
    rng = random.Random(seed)
    parts = ["ab" * 150, "x" * 199, "x" * 260, *("".join(rng.choices("abcdé \n", k=230)) for _ in range(6))]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(4)))) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    rules = run_index.RepeatRules(crowd=rng.choice([1, 2000]))
    assert rows_of(run_index.remove_repeats(docs, rules, with_kept=False)) == removed(rows, 200)


def test_repeats_at_the_edges_of_a_common_passage(spark, monkeypatch, tmp_path):
    """Every document has other text on both sides, so contexts of one key differ by document."""
    rng = random.Random(11)
    passage = "".join(rng.choices("abcdefgh ", k=260))
    sides = ["".join(rng.choices("ijklmnop ", k=80)) for _ in range(160)]
    rows = [(i, sides[i] + passage + sides[-i]) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    rules = run_index.RepeatRules(crowd=10, block=4000)
    indexed = run_index._groups

    def groups(batches):
        for group in indexed(batches):
            size = sum(len(part) for _, part, _ in group)
            (tmp_path / f"{size}-{random.getrandbits(60)}").touch()
            yield group

    monkeypatch.setattr(run_index, "_groups", groups)
    assert rows_of(run_index.remove_repeats(docs, rules, with_kept=False)) == removed(rows, 200)
    assert max(int(p.name.split("-")[0]) for p in tmp_path.iterdir()) <= rules.block


def mixture(rows, rules):
    """The mix word by word: (doc_id, source, size, taken, first slot, slots) of each row, and the
    words each source gives, in the order of the schedule."""
    docs = [(i, s, len(WORD.findall(t or "")), t) for i, t, s in rows]
    whole = Counter()
    for _, source, size, _ in docs:
        whole[source] += size
    names = sorted((s for s in whole if s is not None)) + ([None] if None in whole else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, left, total = {}, set(names), sum(whole.values())
    while True:  # what is above stops, the rest is shared anew
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in left) if left else 0
        above = {s for s in left if weight[s] * level > 3 * whole[s]}
        if not above:
            break
        target |= {s: 3 * whole[s] for s in above}
        left -= above
    target |= {s: weight[s] * level for s in left}
    block = {s: min(rules.block_words, max(1, int(target[s] / rules.least_slots))) for s in names}
    owes = {s: target[s] / block[s] for s in names}
    step, circle = mixing.golden_step(), 1 << 31
    drawn, slots = Counter(), {s: [] for s in names}
    for slot in range(round(sum(owes.values()))):
        point, upto = (slot + 1) * step % circle / circle * sum(owes.values()), 0
        for source in names:
            upto += owes[source]
            if point < upto:
                break
        slots[source].append(slot)
        drawn[source] += 1
    return docs, whole, target, block, slots


def test_mixture(spark, documents, awkward, no_documents):
    rules = mixing.MixRules(block_words=64)
    rows = mixing.mix(documents, rules).collect()
    docs, whole, target, block, slots = mixture(awkward, rules)
    assert sorted(((r.doc_id, r.source, r["size"]) for r in rows), key=repr) == sorted(
        ((i, s, n) for i, s, n, _ in docs), key=repr
    )
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"] and (r.first_slot is None) == (r.taken == 0)
        assert r.source_size == whole[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == 0 or r.first_slot in slots[r.source]
        assert r.n_slots <= len(slots[r.source]) + 3
        taken[r.source] += r.taken
    for source, places in slots.items():
        assert taken[source] == min(len(places) * block[source], 3 * whole[source])
        assert abs(taken[source] - target[source]) <= max(5 * block[source], 0.02 * target[source])
    # the first word of each source's stream is read at its first slot
    first = {}
    for r in rows:
        if r.taken:
            first[r.source] = min(r.first_slot, first.get(r.source, r.first_slot))
    assert first == {s: places[0] for s, places in slots.items() if s in first}
    again = mixing.mix(documents.repartition(5), rules)
    assert rows_of(again) == sorted((tuple(r) for r in rows), key=repr)
    assert mixing.mix(no_documents).count() == 0


def test_the_schedule_decides(spark, documents, monkeypatch):
    before = rows_of(mixing.mix(documents))
    monkeypatch.setattr(mixing, "GOLDEN", 0.0)
    assert rows_of(mixing.mix(documents)) != before


def test_schedule_is_even(spark):
    """Every stretch of the schedule holds the sources in nearly the wanted shares."""
    docs = spark.createDataFrame(
        [(i, " ".join(["w"] * 40), "abc"[i % 3]) for i in range(900)],
        "doc_id bigint, text string, source string",
    )
    rules = mixing.MixRules(block_words=50, least_slots=1)
    sources = mixing._blocks(mixing.source_targets(mixing.sizes(docs.select("doc_id", "source", "text")), rules), rules)
    slots = mixing.schedule(sources).orderBy("slot").collect()
    wanted = {r.sid: r.owes for r in sources.collect()}
    found = Counter(s.sid for s in slots)
    assert all(abs(found[sid] - n) < 3 for sid, n in wanted.items())
    assert [s.slot for s in slots] == list(range(len(slots)))
    for sid in wanted:
        assert [s["rank"] for s in slots if s.sid == sid] == list(range(found[sid]))
    for start in range(0, len(slots) - 100, 50):
        part = Counter(s.sid for s in slots[start : start + 100])
        assert all(abs(part[sid] - 100 * n / len(slots)) < 5 for sid, n in wanted.items())


def test_many_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_COPIES", 7)
    same = [(1, "a b c", "s")] * 50 + [(None, f"n{i} x", "s") for i in range(30)] + [(3, "z " * 90, "t")]
    docs = spark.createDataFrame(same, "doc_id bigint, text string, source string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == 81 and len({r.taken for r in rows if r.doc_id is None}) <= 3
    docs2, whole, target, block, slots = mixture(same, mixing.MixRules())
    for source in "st":
        words = sum(r.taken for r in rows if r.source == source)
        assert words == min(len(slots[source]) * block[source], 3 * whole[source])


def test_mixed_documents_follow_the_schedule(spark):
    rng = random.Random(6)
    same = [(i, words(rng, 30), "abcd"[i % 4 if i % 3 else 0]) for i in range(400)]
    docs = spark.createDataFrame(same, "doc_id bigint, text string, source string")
    rules = mixing.MixRules(least_slots=40)
    found = mixing.mixed_documents(docs, rules).collect()
    mixed = {r.doc_id: r for r in mixing.mix(docs, rules).collect()}
    counts = Counter(r.doc_id for r in found)
    assert all(counts[i] == round(m.taken / m["size"]) for i, m in mixed.items() if m.taken % m["size"] * 2 != m["size"])
    seen, order = set(), []
    for r in found:
        if r.doc_id not in seen:
            seen.add(r.doc_id)
            order.append(mixed[r.doc_id].first_slot)
    assert order == sorted(order) and len(order) > 200


def test_mixed_documents(spark, documents, awkward):
    clashing = documents.select("doc_id", "text", "source").withColumns(
        {name: F.lit(name) for name in ("_id", "times", "_words", "taken", "of_id")}
    )
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    counts = Counter(tuple(r)[:3] for r in mixed.collect())
    assert set(counts) <= {(i, t, s) for i, t, s in awkward}
    assert counts[4, None, "b"] == 1
    mine = Counter((i, t, s) for i, t, s in awkward)
    assert all(counts[row] <= 3 * mine[row] for row in counts)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def private(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))]
    found += [
        (m.start(), 2, m.end())
        for m in CARD.finditer(text)
        if 14 <= len(digits(m)) <= 19 and sanitise.luhn(digits(m))
    ]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return [(a, b, sanitise.KINDS[k]) for a, k, b in sorted(found)]


def test_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("aZ0129..@@+-_% (4é") for _ in range(rng.randrange(45)))
        assert sanitise.base_spans(text) == private(text)
    assert sanitise.base_spans("4111 1111 1111 1111") == [(0, 19, "card")]
    assert sanitise.base_spans("1" * 300_000 + "@" + "a" * 300_000 + "@") == []


def test_words_around_a_mention_are_whole():
    rng = random.Random(2)
    for _ in range(300):
        made = ["x" * rng.choice([1, 3, 50, 900]) + str(i) for i in range(rng.randrange(14))]
        text = "  ".join(made)
        place = rng.randrange(len(text) + 1)
        assert sanitise._last_words(text, place, 5) == text[:place].split()[-5:]
        assert sanitise._first_words(text, place, 5) == text[place:].split()[:5]


def test_spans(documents, awkward, no_documents):
    rows = sanitise.digest(sanitise.find_spans(documents)).collect()
    expected = []
    for doc_id, text, _ in awkward:
        spans = private(text or "")
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        counts = Counter(k for *_, k in spans)
        expected.append((doc_id, *(counts[k] for k in sanitise.BASE_KINDS), hashlib.sha256(line.encode()).hexdigest()))
    found = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert sanitise.find_spans(no_documents).count() == 0


@pytest.mark.parametrize("most", [50_000, 0])
def test_disclosing_terms(spark, most):
    """A rare name that stands by an address in different contexts goes; common words and copies stay."""
    rng = random.Random(3)
    filler = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]

    def some(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    rows = [(i, f"{some(30)} zaphod writes from zb@galaxy.example.com today {some(30)}") for i in range(5)]
    rows += [(10 + i, some(60)) for i in range(300)]
    rows += [(400 + i, "copied rareword by cc@galaxy.example.com only") for i in range(6)]
    rows += [(500, "Here Zaphod is alone.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    terms = {r.term for r in sanitise.disclosing_terms(docs).collect()}
    assert "zaphod" in terms and "rareword" not in terms and not terms & set(filler)
    spans = {r.doc_id: r for r in sanitise.digest(sanitise.find_spans(docs, broadcast_terms=most)).collect()}
    assert spans[500].n_term == 1 and spans[500].spans == "term:5:11"
    clean = {r.doc_id: r for r in sanitise.sanitised_documents(docs, broadcast_terms=most).collect()}
    assert clean[500].text == "Here <TERM> is alone." and clean[500].n_chars == 21
    assert "<EMAIL>" in clean[400].text and "zaphod" not in clean[0].text
    assert clean[10].text == dict(rows)[10]


def test_copies_hide_no_disclosing_terms(spark):
    rng = random.Random(4)

    def some(n):
        return " ".join("".join(rng.choices("abcdefghij", k=4)) for _ in range(n))

    rows = [f"{some(30)} zaphod writes from zb@galaxy.example.com today {some(30)}" for _ in range(5)]
    rows += [some(60) for _ in range(100)] + ["Here zaphod is alone."]

    def told(texts):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
        return sorted(tuple(r) for r in sanitise.disclosing_terms(docs).collect())

    found = told(rows)
    assert "zaphod" in {term for term, *_ in found}
    assert told(rows + rows[:1] * 50) == found
    assert told(rows + rows[-1:] * 200) == found
