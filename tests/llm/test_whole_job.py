import numpy as np

from fleetlens.llm.embedding_dedup import near_vectors
from fleetlens.llm.ngram_join import similar_documents


def test_null_id_copy_before_a_near_group_takes_no_links(spark):
    words = [f"word{i}" for i in range(60)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "changed"]), " ".join(["changed", *words[1:]])
    docs = [(None, text), (None, near), (2, text), (1, near), (3, other), (None, other), (9, "another text on its own")]
    got = similar_documents(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(1, 1), (2, 1), (3, 1), (9, 9)]
    assert [r.component_id for r in got if r.doc_id is None] == [None] * 3


def test_near_vectors_in_a_dense_cone_are_found(spark):
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(64))
    cone = unit(np.sqrt(0.9) * centre + np.sqrt(0.1) * unit(rng.standard_normal((1000, 64))))
    aside = rng.standard_normal((150, 64))
    aside = unit(aside - (aside * cone[:150]).sum(axis=1, keepdims=True) * cone[:150])
    copies = 0.955 * cone[:150] + np.sqrt(1 - 0.955**2) * aside
    spread = unit(rng.standard_normal((2000, 64)))
    x = np.concatenate([cone, copies, spread])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    got = {r.vec_id: r.component_id for r in near_vectors(df, window=4, block=128).collect()}
    assert len(got) == len(x)
    near = np.argwhere(np.triu(x @ x.T >= 0.95, 1))
    assert len(near) >= 150
    assert np.mean([got[a] == got[b] for a, b in near.tolist()]) >= 0.98
