import collections
import hashlib
import os
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from strataframe.llm import bpe, license_scan, ngram_join, packing, pu_quality, quality_rules, sharding, sstable, substring_dedup, weighted_fingerprint
from strataframe.llm.common import new_folder
from strataframe.llm.queries import BYTE_BPE, BYTE_RANKS, WORD_BPE
from strataframe.llm.shingles import WordHashes

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
ODD = ["", None, " ", "\n\n", "a", "don't stop.\n\n \tx  y,z...", "日本 é İΣ. <|endoftext|>", "x" * 5000, "the cat sat on the mat " * 300, "one two", "one two"]


def made(seed=1, n=60):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    texts = []
    for _ in range(n):
        if texts and rnd.random() < 0.5:
            parts = rnd.choice(texts).split(" ")
            for _ in range(rnd.randint(0, 4)):
                parts[rnd.randrange(len(parts))] = rnd.choice(words)
            texts.append(" ".join(parts))
        else:
            texts.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 120))))
    return texts + ODD


def table(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t) for i, t in enumerate(texts)], DOCS).repartition(3)


def test_bpe_is_tiktokens_and_goes_back(spark):
    import tiktoken

    path = BYTE_RANKS
    ranks = bpe.load_ranks(path)
    known = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = made()
    for r in bpe.decode(bpe.encode(table(spark, texts), path), path).collect():
        t = texts[r.doc_id] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == known.encode_ordinary(t)
        assert bytes(r.decoded) == t.encode()
    assert bpe.encode(table(spark, []), path).count() == 0


def test_perfect_hash_is_minimal_and_exact():
    items = {bytes([i % 251, i // 251, 7]): i for i in range(3000)}
    h = bpe.PerfectHash(items)
    assert len(h.keys) == len(items) and None not in h.keys
    assert all(h.get(k) == v for k, v in items.items()) and h.get(b"none") == -1


def brute_components(texts):
    sets = []
    for t in texts:
        w = [x for x in re.split("[ \t-\r]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(rnd, size, edits, n, kept=0):
    """``n`` texts of ``size`` words, with up to ``edits`` words of one text changed; ``kept`` of them only at its end."""
    base = [f"w{i}" for i in range(size)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(kept, size)] = f"v{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("block", "broadcast", "hot"), [(512, 1_000_000, 4096), (3, 0, 2)])
def test_ngram_join_is_brute_force(spark, block, broadcast, hot):
    rnd = random.Random(8)
    hub = " ".join(f"w{i}" for i in range(90))
    near = [" ".join(f"v{k}" if i in (k, (k * 7) % 90) else f"w{i}" for i in range(90)) for k in range(14)]
    chain = [" ".join(f"c{i}" for i in range(k, k + 80)) for k in range(0, 60, 6)]
    texts = made(n=30) + [hub, *near, hub, *chain, *near_copies(rnd, 120, 6, 20)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.groups(table(spark, texts), block=block, broadcast_ids=broadcast, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)


def test_ngram_join_of_large_groups_without_their_pairs(spark):
    rnd = random.Random(9)
    texts = near_copies(rnd, 150, 9, 30) + near_copies(rnd, 150, 40, 16, kept=75)
    shared = " ".join(f"s{i}" for i in range(40))
    texts += [shared + " " + " ".join(f"o{rnd.randrange(10**6)}" for _ in range(12)) for _ in range(20)]
    rnd.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.groups(table(spark, texts), block=16, hot=30).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)


@pytest.mark.parametrize("parts", [{}, {"told_block": 16}])
def test_ngram_join_of_copies_below_the_threshold_takes_one_round(spark, monkeypatch, parts):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = near_copies(rnd, 150, 3, 20)
    for k in range(90):  # most of them link to no other; all change words that others change too
        words = [x if rnd.random() > 0.03 else f"v{rnd.randrange(10**6)}" for x in base if rnd.random() > 0.02]
        texts += [" ".join(words), " ".join([*words, "tail"])][: 1 + (k % 4 == 0)]
    searches, search = [], ngram_join._search
    monkeypatch.setattr(ngram_join, "_search", lambda *a: searches.append(1) or search(*a))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.groups(table(spark, texts), block=16, **parts).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert len(searches) == 1


def test_needed_is_what_partners_share():
    rnd = random.Random(4)
    for _ in range(4000):
        base = set(range(rnd.randint(5, 60)))
        x, y = ({e for e in base if rnd.random() > 0.2} | {100 + rnd.randrange(90) for _ in range(rnd.randint(0, 9))} for _ in range(2))
        if x and y and x != y and base not in (x, y) and ngram_join.links(len(x), len(y), len(x & y)):
            near = [ngram_join.links(len(base), len(s), len(s & base)) for s in (x, y)]
            if not all(near):
                for s, link, other in zip((x, y), near, near[::-1], strict=True):
                    far, close = ngram_join.needed(len(s ^ base), len(base), len(s))
                    assert len((x ^ base) & (y ^ base)) >= (far if not other else close) >= 1


def test_ngram_join_of_repeated_rows_and_none(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s"), (None, "a b c d e f"), (5, None), (1 - (1 << 63), "z z")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(map(tuple, ngram_join.groups(docs).collect()), key=str)
    assert got == sorted([(1, 2, None), (1, 2, None), (1, 1, 1), (None, 2, None), (5, 0, 5), (1 - (1 << 63), 1, 1 - (1 << 63))], key=str)
    assert sorted(map(tuple, ngram_join.firsts(docs).collect()), key=str) == sorted([(1, "q r s"), (None, "a b c d e f"), (5, None), (1 - (1 << 63), "z z")], key=str)
    assert ngram_join.groups(table(spark, [])).count() == ngram_join.firsts(table(spark, [])).count() == 0


def test_firsts_keeps_a_row_of_each_text(spark):
    schema = "doc_id long, text string, ngram_id int"
    long = " ".join(f"b{i}" for i in range(40))
    rows = [(0, "a a a", 1), (1, "a a a", 2), (1, long, 3), (2, "zz " + long, 4), (0, "a a a", 5)]
    got = ngram_join.firsts(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "ngram_id"]
    assert sorted(r.text for r in got.collect()) == ["a a a", long]
    got = ngram_join.firsts(spark.createDataFrame([rows[0], (3, "a a a", 2), rows[3], (4, long, 7), (5, None, 8), (6, "", 9)], schema))
    assert sorted(map(tuple, got.collect())) == [(0, "a a a", 1), (2, "zz " + long, 4), (5, None, 8), (6, "", 9)]


def test_divide_skip_counts():
    rnd = random.Random(3)
    lists = [sorted(rnd.sample(range(60), rnd.randint(0, 40))) for _ in range(9)]
    counts = collections.Counter(x for one in lists for x in one)
    for t in (1, 3, 5):
        for skipped in range(t):
            assert ngram_join.divide_skip(lists, t, skipped) == {x: n for x, n in counts.items() if n >= t}
            assert ngram_join.divide_skip_arrays([np.array(x, int) for x in lists], t, skipped, 60) == {x: n for x, n in counts.items() if n >= t}


def test_packing_holds_each_id_once(spark):
    from tokenizers import Tokenizer

    path = WORD_BPE
    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    texts = made()
    rows = packing.pack(table(spark, texts), path).collect()
    held = collections.defaultdict(dict)
    windows = collections.defaultdict(list)
    for r in rows:
        held[r.doc_id][r.start] = bytes(r.ids)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        windows[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = np.array([*known.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(held[i][k] for k in sorted(held[i])) == ids
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 2048


def test_differencing_levels_sums():
    rnd = random.Random(2)
    lengths = [rnd.randint(1, 400) for _ in range(300)]
    parts = packing.differencing(lengths, 12)
    sums = [sum(lengths[i] for i in p) for p in parts]
    assert sorted(i for p in parts for i in p) == list(range(300)) and max(sums) - min(sums) <= 3


def test_shards_give_back_and_find(spark):
    from tokenizers import Tokenizer

    path = BYTE_BPE
    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    texts = made()
    shards = sstable.write(table(spark, texts), new_folder(spark, "t"), path)
    before = 0
    got = {r.doc_id: r for r in sstable.read(spark, shards).collect()}
    for i, t in enumerate(texts):
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[i].start == before and np.frombuffer(bytes(got[i].ids), "<u4").tolist() == ids
        before += len(ids)
    uri, entries, _, _ = shards[0]
    reader = sstable.Reader(uri)
    key, start, ids = next(iter(reader.scan()))
    assert [(s, x.tolist()) for s, x in reader.get(key)] == [(start, ids.tolist())] and reader.get(10**9) == []
    assert sstable.write(table(spark, []), new_folder(spark, "t"), path) == []


def test_sharding_table_is_even_and_stable(spark):
    names = [f"s{i}" for i in range(7)]
    table_ = sharding.lookup_table(names, 1009)
    counts = collections.Counter(table_)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table_, fewer, strict=True) if a != 6)
    assert moved < 0.25 * 1009
    rows = spark.createDataFrame([(i, 0) for i in range(50)] + [(None, 0)], "doc_id long, shard int")
    for r in sharding.shard(rows, names, size=1009).collect():
        key = "\\N" if r.doc_id is None else str(r.doc_id)
        assert r.shard_2 == table_[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 1009]


def dice_scores(text, templates):
    """Template -> its best Dice coefficient in lines, the whole text and all windows of words, in plain Python."""
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    pairs = lambda w: set(zip(w, w[1:], strict=False))
    whole, out = words(text or ""), {}
    units = [pairs(words(x)) for x in (text or "").split("\n")] + [pairs(whole)]
    for name, t in templates.items():
        own = pairs(words(t))
        longest = int(1.5 * (len(words(t)) - 1))
        cells = units + [pairs(whole[i:j]) for i in range(len(whole)) for j in range(i + 2, min(len(whole), i + longest + 1) + 1)]
        out[name] = max((2 * len(own & u) / (len(own) + len(u)) for u in cells if u or own), default=0.0)
    return out


def test_license_scan_is_brute_force(spark):
    rnd = random.Random(11)
    small = {k: license_scan.TEMPLATES[k] for k in ("all-rights-reserved", "mit", "cc-by-4.0", "gpl-3.0", "bsd-notice")}
    texts = ["x\nReleased under the MIT License.\ny", "All rights reserved", None, "", "a\n\nb", *small.values()]
    for t in small.values():  # words changed, left out and put in, inside other words and over lines
        w = t.split()
        for _ in range(3):
            v = [x for x in w if rnd.random() > 0.1]
            v.insert(rnd.randrange(len(v) + 1), "extra")
            texts.append("some words before\n" + " ".join(v).replace(" the ", "\nthe ") + " and after it")
    got = {r.doc_id: r for r in license_scan.scan(table(spark, texts), small).collect()}
    for i, t in enumerate(texts):
        scores = {k: v for k, v in dice_scores(t, small).items() if v >= 0.8}
        assert {x.license: pytest.approx(x.score) for x in got[i].license_all} == scores
        best = max(scores.values(), default=0.0)
        assert got[i].license_score == pytest.approx(best) and (got[i].license in scores if scores else got[i].license is None)
        if scores:
            assert scores[got[i].license] == pytest.approx(best)


def test_license_scan_passes_other_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "Released under the MIT License.", "mine")], "doc_id long, text string, License string")
    row = license_scan.scan(rows).first()
    assert (row["License"], row["license_2"]) == ("mine", "mit")
    assert license_scan.scan(table(spark, [])).count() == 0
    whole = "\n".join(textwrap.wrap(license_scan.TEMPLATES["mit-text"], 70))
    assert license_scan.scan(table(spark, ["Copyright 2020 Someone\n\n" + whole + "\n"])).first().license == "mit-text"


def test_license_notices_are_found_wrapped_and_inside_lines(spark):
    rnd = random.Random(6)
    fill = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    texts, names = [], []
    for name, notice in license_scan.TEMPLATES.items():
        texts += [textwrap.fill(notice, 72) + "\n\n" + fill(600), f"{fill(9)}. {notice} {fill(9)}.", fill(200) + "\n// " + textwrap.fill(notice, 40, break_long_words=False).replace("\n", "\n// ") + "\n" + fill(200)]
        names += [name] * 3
    texts += [fill(30) + " Copyright (c) 2024 Example Inc. All rights reserved. " + fill(30), "All of it is free. The rights of the reader are reserved. " * 9]
    names += ["all-rights-reserved", None]
    got = {r.doc_id: r for r in license_scan.scan(table(spark, texts)).collect()}
    for i, name in enumerate(names):
        assert got[i].license == name
        assert (got[i].license_score == 1.0 and got[i].license_matches > 0) if name else got[i].license_matches == 0


def test_all_licenses_of_a_text_are_given(spark):
    t = license_scan.TEMPLATES
    texts = [f"a b c\n{t['mit']}\nd e f {t['cc-by-4.0']} g h\nReleased under the great MIT License.\n" + "i j k " * 20, t["apache-2.0-header"], "none", None]
    got = {r.doc_id: r for r in license_scan.scan(table(spark, texts)).collect()}
    assert [tuple(x) for x in got[0].license_all] == [("cc-by-4.0", 1.0), ("mit", 1.0)] and got[0].license == "cc-by-4.0"
    assert [tuple(x) for x in got[1].license_all] == [("apache-2.0", 1.0), ("apache-2.0-header", 1.0)] and got[1].license == "apache-2.0-header"
    assert got[2].license_all == got[3].license_all == []
    assert license_scan.scan(table(spark, texts), {}).collect()[0].license_all == []


def test_quality_counts_are_brute_force(spark):
    texts = made() + ["# a b c\n# a b c\n\n x a b c a b", "A!! B!! " * 40, "w### " * 80]
    got = {r.doc_id: r for r in quality_rules.judge(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = [x for x in re.split("[ \t-\r]+", t) if x]
        seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search("[^ \t-\r]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)


def test_votes_that_agree_part_the_classes():
    good = quality_rules.expectation_maximisation({"111111": 800, "000111": 70, "111000": 30, "-11111": 20})
    assert good["111111"] > 0.9 > 0.1 > good["000111"] and good["-11111"] > 0.9


def test_passages_go_and_offsets_hold(spark):
    passage = "The " + " ".join(f"p{i}" for i in range(60)) + "."
    texts = ["Head of one. " + passage, "other words here " + passage + " and more words after it", "Line\nalone here", "Line\nnew text", None, ""]
    got = {r.doc_id: r for r in substring_dedup.dedup(table(spark, texts), min_line=1).collect()}
    assert got[0].text == texts[0] and got[0].removed_spans == []
    assert passage[20:200] not in got[1].text and got[1].text.startswith("other words here") and "after it" in got[1].text
    assert got[3].text == "new text" and got[4].text is None and got[5].text == ""
    forced = {r.doc_id: r.text for r in substring_dedup.dedup(table(spark, texts), min_line=1, local=1).collect()}
    assert forced == {k: r.text for k, r in got.items()}
    for i, r in got.items():
        kept, at = "", 0
        for s in r.removed_spans:
            kept += texts[i][at : s.begin]
            at = s.stop
        assert kept + (texts[i] or "")[at:] == (r.text or "") or r.text is None


def rest_of(spark, texts):
    """Document -> the words left of it, after a check that its spans give its text."""
    out = {}
    for r in substring_dedup.dedup(table(spark, texts)).collect():
        kept, at = "", 0
        for s in r.removed_spans:
            kept += texts[r.doc_id][at : s.begin]
            at = s.stop
        assert kept + texts[r.doc_id][at:] == r.text
        out[r.doc_id] = r.text.split()
    return out


def test_every_passage_of_over_50_words_goes(spark):
    rnd = random.Random(3)
    fill = lambda n: ["".join(rnd.choice("abcdefgh") for _ in range(8)) for _ in range(n)]
    breaks = lambda words, n: " ".join(w + "\n" * (k % n == n - 1) for k, w in enumerate(words))
    texts, passages = [], []
    for k in range(40):
        passage = fill(51)
        passages.append(passage)
        texts.append(" ".join([*fill(20), *passage, *fill(20)]))
        around = [*fill(rnd.randint(0, 30)), *passage, *fill(rnd.randint(0, 30))]
        texts.append([" ".join(around), breaks(around, 12), breaks(around, 7), " ".join(around) + "."][k % 4])
    left = rest_of(spark, texts)
    for k, passage in enumerate(passages):
        assert left[2 * k] == texts[2 * k].split()
        still = set(left[2 * k + 1])
        gone = [w not in still for w in passage]
        edge = substring_dedup.SPAN - 1
        assert all(gone[edge : 51 - edge])
        assert len(left[2 * k + 1]) == len(texts[2 * k + 1].split()) - sum(gone)  # nothing else goes


def test_a_passage_repeated_in_a_text_stays_once(spark):
    words = [f"w{i}" for i in range(60)]
    left = rest_of(spark, [" ".join([*words, "between", *words]), "the cat sat on the mat " * 50])
    assert left[0][:61] == [*words, "between"] and len(left[0]) <= 61 + 2 * (substring_dedup.SPAN - 1)
    assert left[1][:25] == ("the cat sat on the mat " * 5).split()[:25] and len(left[1]) < 60


def test_case_makes_no_other_passage_or_line(spark):
    rnd = random.Random(4)
    fill = lambda n: " ".join(rnd.choice("ABcdef") + "".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    lines, passages = [fill(12) for _ in range(12)], [fill(60) for _ in range(6)]
    changes = [str.lower, str.upper, str.title]
    texts = ["\n".join(lines), *passages]
    texts += [f"own{k}{change.__name__}\n{change(line)}\nend{k}{change.__name__}" for k, line in enumerate(lines) for change in changes]
    begin = len(texts)
    texts += [f"own{k}{change.__name__} {change(p)} end{k}{change.__name__}" for k, p in enumerate(passages) for change in changes]
    left = rest_of(spark, texts)
    assert all(len(left[k]) == 2 for k in range(1 + len(passages), begin))
    assert all(len(left[k]) <= 2 + 2 * (substring_dedup.SPAN - 1) for k in range(begin, len(texts)))


def jaccard(a, b):
    x, y = (collections.Counter(w for w in re.split("[ \t-\r]+", t) if w) for t in (a, b))
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / max(1, sum(max(x[k], y[k]) for k in keys))


def test_fingerprints_estimate_jaccard(spark):
    texts = [t for t in made(n=40) if t is not None and len(t) < 3000]
    got = {r.doc_id: r for r in weighted_fingerprint.with_edits(table(spark, texts), samples=32).collect()}
    errors = []
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        if t.split() and after.split():
            errors += [got[i].near_edited - jaccard(t, edited), got[i].near_next - jaccard(t, after)]
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.12
    assert got[len(texts) - 1].fingerprint == got[len(texts) - 2].fingerprint  # equal texts


def test_classifier_holds_out_well(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 7)))
    texts, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        texts.append(" ".join(word() + ("###" if bad else "") for _ in range(80)))
        if i % 2 == 0 or bad:
            labels.append((i, 0 if bad else 1))
    docs, marks = table(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")
    model, prior = pu_quality.train(docs, marks)
    assert 0.3 < prior <= 0.95
    got = {r.doc_id: r.score for r in pu_quality.score(docs, model).collect()}
    held = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (q == 1) for i, q in held]) > 0.9
    assert pu_quality.train(docs, marks.where("quality = 7")) == (None, 0.5)
    assert not pu_quality.measures(None, WordHashes()).any()


def test_fingerprints_of_odd_rows(spark):
    schema = "doc_id long, text string, copies long"
    rows = [(None, "z z y", 1), (1, None, 1), (2, "", 1), (3, "a b c d", 1), (3, "a b c d", 1), (4, "A B c  d", 9)]
    got = weighted_fingerprint.with_edits(spark.createDataFrame(rows, schema), samples=8).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 5), (1, 0), (2, 0), (3, 7), (3, 7), (4, 8)]
    at = {r.doc_id: r for r in got}
    assert at[3].fingerprint == at[4].fingerprint and set(at[1].fingerprint) == {"0"} and at[1].near_next == 1.0 and at[2].near_next == 0.0
    assert at[4].edited_sha256 == hashlib.sha256(b"A B c z ").hexdigest() and at[1].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert weighted_fingerprint.with_edits(spark.createDataFrame([], schema), samples=8).count() == 0


def plain_dedup(rows, min_words, min_line):
    """(text, spans) of each row by the documented rule, with word tuples for digests."""
    cut = []
    for _, text in rows:
        words = [m for m in re.finditer(r"\S+", text or "")]
        low = [m.group().lower() for m in words]
        first = np.array([xxhash_of(w) for w in low], np.uint64)
        begins = substring_dedup.window_starts(first, min_words).tolist() if low else []
        lines, at = [], 0
        for line in (text or "").split("\n"):
            inside = [k for k, m in enumerate(words) if at <= m.start() < at + len(line)]
            lines.append((at, at + len(line), inside))
            at += len(line) + 1
        cut.append((words, low, begins, lines))
    owner = {}
    for (key, _), (_, low, begins, lines) in zip(rows, cut, strict=True):
        units = [tuple(low[a : a + min_words]) for a in begins] + [tuple(low[k] for k in x) for _, _, x in lines if len(x) >= min_line]
        for u in units:
            owner[u] = min(owner.get(u, 1 << 62), -(1 << 62) if key is None else key)
    out = []
    for (key, text), (words, low, begins, lines) in zip(rows, cut, strict=True):
        own, gone, seen, stays = (-(1 << 62) if key is None else key), set(), set(), {}
        for _, _, inside in lines:
            u = tuple(low[k] for k in inside)
            if len(u) >= min_line:
                if owner[u] < own or u in seen:
                    gone |= set(inside)
                seen.add(u)
        for a in begins:
            u = tuple(low[a : a + min_words])
            if owner[u] < own or stays.setdefault(u, a) + min_words <= a:
                gone |= set(range(a, a + min_words))
        spans = []
        for begin, stop, inside in lines:
            if inside and gone.issuperset(inside):
                spans.append((begin, min(stop + 1, len(text))))
                continue
            for k in inside:
                if k in gone:
                    after = words[k + 1].start() if k + 1 in inside else stop
                    if spans and spans[-1][1] == words[k].start() and k - 1 in inside:
                        spans[-1] = (spans[-1][0], after)
                    else:
                        spans.append((words[k].start(), after))
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at:a], b
        out.append((kept + text[at:] if spans else text, spans))
    return out


def xxhash_of(word):
    import xxhash

    return int.from_bytes(xxhash.xxh3_128_digest(word.encode())[:8], "little")


@pytest.mark.parametrize(("local", "least"), [(16, 10), (1, 1), (2, 4)])
def test_substring_dedup_is_brute_force(spark, local, least):
    rnd = random.Random(12)
    fill = lambda n: [rnd.choice("ABcdef") + "".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    passages, lines = [fill(60) for _ in range(5)], [" ".join(fill(rnd.randint(1, 9))) for _ in range(8)]
    texts = [None, "", " \n ", "one", "One\none"]
    for _ in range(40):
        parts = []
        for _ in range(rnd.randint(1, 6)):
            parts.append(rnd.choice([lambda: "\n" + rnd.choice(lines) + "\n", lambda: " ".join(rnd.choice(passages)), lambda: " ".join(fill(rnd.randint(1, 30))), lambda: "\n".join(rnd.choice(passages)).upper()])())
        texts.append(" ".join(parts))
    ids = [None, 3, *range(5, 5 + len(texts) - 2)]
    rows = list(zip(ids, texts, strict=True)) + [(7, texts[4]), (9, texts[6])]  # one repeated row and one identifier with another text
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, removed_spans int").repartition(3)
    got = {r["removed_spans"]: (r["text"], [tuple(x) for x in r["removed_spans_2"]]) for r in substring_dedup.dedup(frame, min_line=least, local=local).collect()}
    assert [got[k] for k in range(len(rows))] == plain_dedup(rows, substring_dedup.MIN_WORDS, least)
    assert substring_dedup.dedup(table(spark, []), local=local).count() == 0


def plain_measures(text):
    words = [w for w in re.split("[ \t\n\r\x0b\x0c]+", text or "") if w]
    if not words:
        return [0.0] * len(pu_quality.FEATURES)
    raw = [w.encode() for w in words]
    joined = b"".join(raw)
    n, chars = len(words), max(1, len(joined))
    count = lambda some: sum(joined.count(bytes([c])) for c in some)
    triples = list(zip(words, words[1:], words[2:], strict=False))
    seen = collections.Counter(triples)
    lines = [x for x in (text or "").encode().split(b"\n") if x.strip()]
    letters = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789#*$%&<>!?|.,;:'\"()-") + sum(c > 127 for c in joined)
    lengths = [len(x) for x in raw]
    return [
        np.log1p(n), count(b"#*$%&<>") / n, (len(joined) - letters) / chars, count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, count(b"0123456789") / chars, count(b"!?") / n, count(b"|") / n,
        sum(seen[t] > 1 for t in triples) / len(triples) if triples else 0.0, 1 - len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)), min(30.0, float(np.mean(lengths))),
        sum(x <= 3 for x in lengths) / n, np.log1p(n / max(1, len(lines))), count(b".,;:'\"()-") / n,
    ]


def test_classifier_scores_are_brute_force(spark):
    texts = made() + ["# A!! 12 | (b)\n# A!! 12 | (b)\n~~ é"]
    x = np.array([plain_measures(t) for t in texts])
    memo = WordHashes()
    assert np.allclose(x, [pu_quality.measures(t, memo) for t in texts])
    model = pu_quality.fit(x[:20], x[20:], 0.4, rounds=50)
    rows = [(i, t, 0.25) for i, t in enumerate(texts)] + [(0, texts[0], 0.5), (None, texts[1], 0.5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    scored = pu_quality.score(frame, model, keep=["doc_id", "score"])
    assert scored.columns == ["doc_id", "score", "score_2"]
    spread = np.hstack([x, x**2])
    z = np.clip((spread - model.mean) / model.scale, -8, 8) @ model.weights + model.bias
    plain = 1 / (1 + np.exp(-z))
    for r in scored.collect():
        assert r.score_2 == pytest.approx(plain[1 if r.doc_id is None else r.doc_id])
    flags = frame.select("doc_id", pu_quality.held_out(frame["doc_id"]).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in flags)
    none = table(spark, [])
    assert pu_quality.train(none, spark.createDataFrame([], "doc_id long, quality int")) == (None, 0.5)
    assert pu_quality.score(none, None).count() == 0


def test_fit_lowers_the_non_negative_risk():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1.5, 1, (400, 4)), rng.normal(-1.5, 1, (400, 4))
    positive, unlabelled, prior = good[:150], np.vstack([good[150:], bad]), 250 / 650

    def risk(model):
        loss = lambda x, y: float(np.mean(-np.log(np.clip(model.score(x) if y else 1 - model.score(x), 1e-12, 1))))
        return prior * loss(positive, 1) + max(0.0, loss(unlabelled, 0) - prior * loss(positive, 0))

    start, done = pu_quality.fit(positive, unlabelled, prior, rounds=0), pu_quality.fit(positive, unlabelled, prior)
    assert risk(done) < 0.5 * risk(start)
    assert (done.score(good) > 0.5).mean() > 0.95 > 0.05 > (done.score(bad) > 0.5).mean()


def test_class_prior_counts_every_unlabelled_text(spark):
    rnd = random.Random(2)
    texts = [" ".join("x" * rnd.randint(1, 9) for _ in range(60)) for _ in range(90)]
    x = np.array([pu_quality.measures(t, WordHashes()) for t in texts])
    model, at, above, n = pu_quality.thresholds(x[:40], x[40:])
    counts = pu_quality.counts_above(table(spark, texts), "text", model, at)
    assert counts.tolist() == [90, *[(model.score(x) >= a).sum() for a in at]]
    assert 0.05 <= pu_quality.class_prior(counts, above, n) <= 0.95
    assert pu_quality.counts_above(table(spark, []), "text", model, at).tolist() == [0] * (len(at) + 1)


def plain_em(patterns, rounds):
    """The same estimate, text by text."""
    texts = [p for p, n in patterns.items() for _ in range(n)]
    good = [0.1 if "0" in p else 0.9 for p in texts]
    for _ in range(rounds):
        share = (sum(good) + 1) / (len(texts) + 2)
        chance = []
        for j in range(len(texts[0])):
            pair = []
            for weight in ([1 - g for g in good], good):
                voted = [(w, p[j]) for w, p in zip(weight, texts, strict=True) if p[j] != "-"]
                pair.append((sum(w for w, v in voted if v == "1") + 0.5) / (sum(w for w, _ in voted) + 1))
            chance.append([sum(pair) / 2] * 2 if pair[0] > pair[1] else pair)
        new = []
        for p in texts:
            yes, no = share, 1 - share
            for v, (a, b) in zip(p, chance, strict=True):
                if v != "-":
                    yes, no = yes * (b if v == "1" else 1 - b), no * (a if v == "1" else 1 - a)
            new.append(yes / (yes + no))
        good = new
    return dict(zip(texts, good, strict=True))


def test_posteriors_and_verdicts_are_brute_force(spark):
    patterns = {"111": 30, "110": 6, "011": 4, "000": 9, "1-0": 5, "---": 3, "0-1": 2}
    got = quality_rules.expectation_maximisation(patterns, rounds=25)
    assert got == pytest.approx(plain_em(patterns, 25))
    texts = made(n=40) + ["A!! B!! " * 40, "w### " * 80, " ".join(f"Word{i}" for i in range(70))]
    rows = [(i, t, f"m{i}") for i, t in enumerate(texts)] + [(0, texts[0], "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _m string").repartition(3)
    judged = quality_rules.judge(frame)
    assert "_m" in judged.columns
    found = judged.collect()
    counts = collections.Counter(r.votes for r in found)
    posterior = quality_rules.expectation_maximisation(dict(counts))
    limits = list(quality_rules.RULES.values())
    for r in found:
        assert r._m == ("again" if r._m == "again" else f"m{r.doc_id}")
        assert r.posterior == pytest.approx(posterior[r.votes]) and r.kept == (not r.base_failed and r.posterior >= 0.5)
        if r.n_words:
            for measure, k in ((r.n_symbols / r.n_words, 0), (r.n_repeat_words / r.n_words, 3), (r.word_chars / r.n_words, 8)):
                assert r.votes[k] == ("1" if measure <= limits[k][1] else "0" if measure >= limits[k][2] else "-")
        else:
            assert set(r.votes) == {"-"}
    assert quality_rules.judge(table(spark, [])).count() == 0


def plain_fingerprint(text, samples):
    """One value for each sample as the signature defines it, with Spark's hash of terms done by Spark."""
    return collections.Counter(w for w in re.split("[ \t-\r]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w)


def test_fingerprints_are_brute_force(spark):
    from pyspark.sql import functions as F

    texts = ["a b b c", "the cat the dog The cat", "z", "q w e r t y u i o p " * 4]
    samples, m = 6, (1 << 64) - 1
    got = {r.doc_id: r.fingerprint for r in weighted_fingerprint.fingerprints(table(spark, texts), samples=samples).collect()}
    for i, t in enumerate(texts):
        weights = plain_fingerprint(t, samples)
        words = spark.createDataFrame([(w,) for w in weights], "w string").select("w", F.xxhash64("w").alias("h"))
        ones = [F.xxhash64(F.col("h").bitwiseXOR(F.lit(weighted_fingerprint.salt(k)))) for k in range(samples)]
        hashes = {r.w: [int(x) for x in r[1:]] for r in words.select("w", *[y for x in ones for y in (x, F.xxhash64(x))]).collect()}
        parts = []
        for k in range(samples):
            best = None
            for w, n in weights.items():
                one, two = hashes[w][2 * k] & m, hashes[w][2 * k + 1] & m
                unit = lambda bits, shift, width: (((bits >> shift) & ((1 << width) - 1)) + 0.5) / (1 << width)
                r, c = (-np.log(unit(x, 0, 26) * unit(x, 26, 26)) for x in (one, two))
                b = unit(two, 52, 12)
                at = int(np.floor(np.log(n) / r + b))
                value = int((np.log(c) - r * (at - b + 1.0) + 400.0) * (1 << 30))
                own = (one ^ at * 0x9E3779) & 0xFFFFFF
                best = min(best or (1 << 62, 0), (value, own))
            parts.append(f"{best[1]:06x}")
        assert got[i] == "".join(parts)


def test_small_cases_of_the_other_operators(spark):
    none, clash = table(spark, []), spark.createDataFrame([(1, "a b", 7, 8), (1, "a b", 7, 8), (None, None, 0, 0)], "doc_id long, text string, IDS int, shard int")
    assert sharding.shard(none, ["a", "b"], size=11).count() == 0
    coded = bpe.encode(clash, BYTE_RANKS)
    assert coded.columns == ["doc_id", "text", "shard", "ids"] and sorted(len(r.ids) for r in coded.collect()) == [0, 8, 8]
    assert packing.pack(none, WORD_BPE).count() == 0
    pieces = packing.pack(clash, WORD_BPE).collect()
    lengths = collections.Counter()
    for r in pieces:
        lengths[r.doc_id] += r.length
    assert lengths == {None: 1, 1: 6}
    shards = sstable.write(clash, new_folder(spark, "t"), BYTE_BPE)
    assert sorted((r.doc_id is not None, r.start, r.n_tokens) for r in sstable.read(spark, shards).collect()) == [(False, 0, 1), (True, 1, 3), (True, 4, 3)]


def test_packing_pads_little(spark):
    texts = made(n=200)
    rows = packing.pack(table(spark, texts), WORD_BPE).collect()
    filled = collections.Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
    total = sum(filled.values())
    slots = sum(2048 if n > 1024 else 1 << max(0, n - 1).bit_length() for n in filled.values())
    assert max(filled.values()) <= 2048 and slots <= 1.1 * total + 2048


def test_ngram_join_matches_its_sql_and_loses_no_link(spark):
    import oracle
    from strataframe.llm import queries

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    con = oracle.connect(sf)
    con.execute("set enable_progress_bar = false")
    for name, sql in queries.ORACLE.items():
        assert oracle.differ(spark, con, queries.QUERIES[name], sql, sf) is None
