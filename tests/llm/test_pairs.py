"""Near duplicates, leaks and the pipeline against brute force."""

import random
import time

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from martlet.llm import decontam, golay_simhash, registry
from martlet.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(ids, prints):
    """Smallest id reachable over links of three bits or fewer, by brute force."""
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, d in enumerate(ids)}


class TestNearDuplicates:
    def test_query_matches_brute_force(self, spark, texts):
        prints = [fingerprint(t) for t in texts.text]
        want = components(texts.doc_id.tolist(), prints)
        got = {r["doc_id"]: r for r in golay_simhash.op10_simhash_near_dedup(spark, SF).collect()}
        assert [got[d]["fingerprint"] for d in texts.doc_id] == [f"{p:016x}" for p in prints]
        assert {d: r["component_id"] for d, r in got.items()} == want

    def test_golay_code_is_perfect(self):
        assert (np.bincount(golay_simhash._indices(), minlength=4096) == 2048).all()

    def test_no_link_is_lost(self, spark):
        """Every pattern of one to three flipped bits finds its partner, chains join."""
        rng = np.random.default_rng(3)
        base = rng.integers(-2**63, 2**63 - 1, 400, dtype=np.int64)
        other = base.copy()
        for bits in range(3):
            other[bits * 100:] ^= np.left_shift(np.int64(1), rng.integers(0, 64, 400 - bits * 100))
        pairs = golay_simhash.near_pairs(spark.createDataFrame([(int(x),) for x in {*base, *other}], "_fp long")).collect()
        found = {(r["u"], r["v"]) for r in pairs}
        want = {(min(a, b), max(a, b)) for a, b in zip(base.tolist(), other.tolist()) if a != b}
        assert want <= found and all(((u ^ v) & (2**64 - 1)).bit_count() <= 3 for u, v in found)

    def test_components_of_a_chain_and_a_star(self, spark):
        chain = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 300)] + [(7, 7)]
        got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
        assert got == {**{i: 0 for i in range(101)}, **{500 + i: 500 for i in range(300)}}

    def test_odd_inputs(self, spark, odd, empty):
        got = golay_simhash.near_duplicates(odd).collect()
        blank = {(r["_fp"], r["component_id"]) for r in got if r["doc_id"] in (1, 2, 3)}
        assert len(got) == 9 and blank == {(0, 1)} and golay_simhash.near_duplicates(empty).count() == 0
        kept = golay_simhash.one_of_each(odd)
        assert kept.columns == odd.columns
        assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 7]

    def test_long_text_in_pieces(self):
        rng = np.random.default_rng(0)
        text = " ".join("w%d" % i for i in rng.integers(0, 10**6, 400_000))
        total, n = golay_simhash.shingle_bits(text.encode())
        words = text.split()
        assert n == len(words) - 2
        some = np.zeros(64, np.int64)
        for i in range(n):
            some += np.unpackbits(np.array([xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42)], ">u8").view(np.uint8))
            if i == 2000:
                break
        assert (total >= some).all() and total.max() <= n


class TestDecontamination:
    ITEM = "What is the capital of the northern province, and who founded it? Explain how the river trade shaped its early growth."

    def index(self):
        return decontam.build_index([(7, self.ITEM), (8, "short")])

    def leaks(self, *texts):
        import pyarrow as pa

        return [(r, i) for r, i, _ in decontam._leaks_of(self.index(), pa.array(texts, pa.string()))]

    def test_exact_and_edited_passages(self):
        filler = "some words that have nothing to do with it at all " * 30
        edited = self.ITEM.replace("northern", "northen").replace("founded", "Founded").replace("river trade", "river  trades")
        assert self.leaks(filler + self.ITEM + filler, self.ITEM.upper(), filler + edited + filler, filler, None, "", self.ITEM[:40], "short", "Far too short!", "shorter", "a foreshort ens") == [
            (0, 7), (1, 7), (2, 7), (7, 8), (8, 8)]

    def test_short_items(self):
        """Fewer characters than a q-gram: exactly, and as whole words where words are parted by spaces."""
        import pyarrow as pa

        index = decontam.build_index([(1, "tiny one"), (2, "答案"), (3, "!?"), (4, "42"), (5, "да")])
        docs = ["a TINY, one!", "tiny ones", "這是答案嗎", "答 案", "it is 42", "1428", "да", "дата", "!?"]
        assert [(r, i, e) for r, i, e in decontam._leaks_of(index, pa.array(docs))] == [(0, 1, 0), (2, 2, 0), (4, 4, 0), (6, 5, 0)]

    def test_phrase_shared_by_many_items(self):
        """Items that open alike: the phrase alone is no leak, and costs little."""
        import pyarrow as pa

        opening = "Which of the following statements best describes "
        draw = random.Random(1)
        tails = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(70)) for _ in range(200)]
        items = [(i, opening + tail) for i, tail in enumerate(tails)]
        index = decontam.build_index(items)
        began = time.time()
        phrase = (opening + "unrelated matters of the day. ") * 100
        found = list(decontam._leaks_of(index, pa.array([phrase, phrase + items[17][1] + phrase, "x " + items[3][1]])))
        assert [(r, i) for r, i, _ in found] == [(1, 17), (2, 3)] and time.time() - began < 60

    def test_parts_of_a_row_lose_nothing(self, monkeypatch):
        """Results do not depend on how many pairs are held at a time."""
        import pyarrow as pa

        items = [(i, decontam.normalised(self.ITEM).decode()[i:] + f" item {i} " + self.ITEM[::-1]) for i in range(12)]
        docs = [items[i][1][i:i + 75] + " filler words " + items[-1 - i][1][5 * i:] for i in range(12)]
        index = decontam.build_index(items)
        want = [(r, i) for r, i, _ in decontam._leaks_of(index, pa.array(docs))]
        monkeypatch.setattr(decontam, "PAIRS", 50)
        monkeypatch.setattr(decontam, "CASES", 7)
        assert [(r, i) for r, i, _ in decontam._leaks_of(index, pa.array(docs))] == want and len(want) > 40

    def test_several_blocks_of_items(self, spark, monkeypatch):
        monkeypatch.setattr(decontam, "BLOCK", 100)
        items = spark.createDataFrame([(i, self.ITEM.replace("river", f"river{i}") if i != 2 else "?") for i in range(5)], "item_id long, text string")
        docs = spark.createDataFrame([(1, self.ITEM.replace("river", "river3")), (2, "clean"), (3, None)], "doc_id long, text string")
        got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()}
        assert got == {(1, i) for i in (0, 1, 3, 4)}
        assert [r["doc_id"] for r in decontam.clean_documents(docs, items).orderBy("doc_id").collect()] == [2, 3]

    @pytest.mark.parametrize("seed", range(3))
    def test_matches_brute_force_edit_distance(self, seed):
        """Random edits of a segment: found exactly if the best local alignment is within budget."""
        rng = np.random.default_rng(seed)
        body = decontam.normalised(self.ITEM)[:decontam.SEGMENT]
        index = decontam.build_index([(1, body.decode())])
        limit = int(index.edits[0])
        for edits in range(0, limit + 5):
            text = list(body)
            for _ in range(edits):
                k = rng.integers(0, len(text))
                text[k:k + 1] = [[], [rng.integers(97, 123)], [text[k], rng.integers(97, 123)]][rng.integers(0, 3)]
            doc = ("xyzzy " * 20 + bytes(text).decode() + " plugh" * 20)
            raw = decontam.normalised(doc)
            row = np.zeros(len(raw) + 1, int)
            for i, c in enumerate(index.text[index.starts[0]:index.starts[0] + index.lengths[0]]):
                new = np.empty_like(row)
                new[0] = i + 1
                for j, d in enumerate(raw):
                    new[j + 1] = min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1)
                row = new
            import pyarrow as pa

            found = list(decontam._leaks_of(index, pa.array([doc])))
            assert bool(found) == (row.min() <= limit)

    def test_every_alignment_of_a_passage(self):
        """A passage of the least length is found wherever it begins, in any script."""
        import pyarrow as pa

        cyrillic = str.maketrans("abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстуввхыз")
        for item, least in ((self.ITEM, 60), (self.ITEM.lower().translate(cyrillic), 36)):
            body = decontam.normalised(item + " " + item[::-1]).decode()
            index = decontam.build_index([(7, body)])
            docs = [f"qq {body[i:i + least]} zz" for i in range(len(body) - least + 1)]
            found = {r for r, _, _ in decontam._leaks_of(index, pa.array(docs))}
            assert found == set(range(len(docs)))

    def test_letters_of_several_bytes(self):
        """Edits count in characters, and few characters of many bytes still match exactly."""
        import pyarrow as pa

        body = decontam.normalised("Назовите столицу северной провинции и объясните как речная торговля изменила город").decode()
        edited = list(body[:64])
        for i in (10, 30, 50):
            edited[i] = "日"
        index = decontam.build_index([(1, body[:64]), (2, "東京大学物理")])
        docs = ["xyz " + "".join(edited) + " xyz", "ab 東京大学物理 cd", "ab 東京大学 cd"]
        assert [(r, i) for r, i, _ in decontam._leaks_of(index, pa.array(docs))] == [(0, 1), (1, 2)]

    def test_query_against_word_windows(self, spark, texts):
        bench = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
        want = {(d, i) for d, t in zip(texts.doc_id, texts.text) for i, x in zip(bench.item_id, bench.text)
                if decontam.normalised(x) in decontam.normalised(t)}
        got = {(r["doc_id"], r["item_id"]) for r in decontam.op6_benchmark_decontamination(spark, SF).collect()}
        assert want <= got and len(got) <= len(want) + 2

    def test_blocks_and_odd_inputs(self, spark, odd, empty, monkeypatch):
        items = [(i, f"{self.ITEM[i:]} number {i} " * 2) for i in range(5)] + [(None, "x" * 50), (9, None), (10, "tiny")]
        bench = spark.createDataFrame(items, "item_id long, text string")
        docs = spark.createDataFrame([(1, items[2][1], 0), (2, "clean", 0)], "doc_id long, text string, item_id int")
        whole = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
        monkeypatch.setattr(decontam, "BLOCK", 100)
        assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()} == whole >= {(1, 2)}
        assert [r["doc_id"] for r in decontam.clean_documents(docs, bench).collect()] == [2]
        assert decontam.contaminated(odd, bench).count() == 0 and decontam.clean_documents(odd, bench).count() == 9
        none = bench.limit(0)
        assert decontam.contaminated(docs, none).count() == 0 and decontam.clean_documents(empty, none).count() == 0


class TestPipeline:
    def test_stages_take_effect(self, spark, texts):
        """Every stage against brute force or its own operator's full result."""
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        columns = docs.columns
        ids = []
        frames = []
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "test")
            frames.append(docs)
            ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        assert all(f.columns == columns for f in frames[:-1])
        kept = {r["doc_id"] for r in registry.QUERIES["op4_quality_rules"](spark, SF).filter("kept").collect()}
        assert ids[0] == kept
        left = texts[texts.doc_id.isin(kept)]
        groups = components(left.doc_id.tolist(), [fingerprint(t) for t in left.text])
        assert ids[1] == set(groups.values())
        hit = {r["doc_id"] for r in registry.QUERIES["op6_benchmark_decontamination"](spark, SF).collect()}
        assert ids[2] == ids[1] - hit and ids[3] == ids[2]
        secret = {r["doc_id"] for r in frames[3].filter("contains(text, '[SECRET]')").collect()}
        spans = {r["doc_id"] for r in registry.QUERIES["op8_secret_scans"](spark, SF).filter("n_assign + n_access + n_hex > 0").collect()}
        assert spans & ids[3] <= secret
        assert frames[3].filter("n_chars <> char_length(text)").count() == 0
        assert ids[4] <= ids[3] and frames[4].filter("copies < 1 or taken > 2 * size").count() == 0
        run = {(r["doc_id"], r["copies"]) for r in corpus_pipeline.run(spark, SF).collect()}
        assert run == {(r["doc_id"], r["copies"]) for r in frames[4].collect()}

    def test_odd_documents(self, spark, odd, empty):
        docs = odd
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, odd, SF)
            assert out.count() <= 9
            assert set(odd.columns) <= set(out.columns), name
            docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "odd")
            assert stage(spark, empty, SF).count() == 0
        assert docs.count() == 0 or docs.count() <= 2
