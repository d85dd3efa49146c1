import corpus_pipeline
from tidegate.llm.common import stored, table
from tidegate.llm.decontamination import contaminated
from tidegate.llm.quality import quality_scores
from tidegate.llm.toxicity import toxicity_scores

from helpers import near_duplicate_groups

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stored(spark, stage(spark, before, SF), name)
        assert docs.columns == columns
        texts = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name in ("quality", "toxicity"):
            score = {"quality": quality_scores, "toxicity": toxicity_scores}[name]
            good = 1 if name == "quality" else 0
            assert kept[name] == {r.doc_id for r in score(before, table(spark, SF, "labels")).collect() if r.predicted == good}
        elif name == "near_duplicates":
            groups = near_duplicate_groups(sorted(texts.items()))
            assert kept[name] == {i for i, g in groups.items() if i == g}
        else:
            items = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
            exact = {i for i, t in texts.items() if any(x in t for x in items.values())}
            found = {r.doc_id for r in contaminated(spark, before, table(spark, SF, "benchmark")).collect()}
            assert exact <= found and kept[name] == set(texts) - found
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in out} == kept["decontamination"] and all(r.n_tokens == len(r.ids) for r in out)
