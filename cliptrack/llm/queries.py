"""The queries of these operators, and SQL for those that SQL can express."""

from __future__ import annotations

from cliptrack.llm.arc_to_warc import OP12_SQL, op12_warc
from cliptrack.llm.context_trees import op2_context_trees
from cliptrack.llm.html_blocks import op9_html
from cliptrack.llm.jaccard_join import op4_ngram_join
from cliptrack.llm.lattice_dups import op10_lattice
from cliptrack.llm.mixing import OP6_SQL, op6_mixing
from cliptrack.llm.piece_lattice import op5_pieces
from cliptrack.llm.pii import op3_pii
from cliptrack.llm.prefix_trie import OP11_SQL, op11_trie
from cliptrack.llm.rotated_codes import op7_nearest
from cliptrack.llm.shared import visible
from cliptrack.llm.sharding import op8_sharding
from cliptrack.llm.structure_repair import OP13_SQL, op13_repair
from cliptrack.llm.toxicity import op1_toxicity


def _query(run):
    def call(spark, sf_dir):
        visible(spark)
        return run(spark, sf_dir)

    return call


QUERIES = {
    run.__name__: _query(run)
    for run in (
        op1_toxicity,
        op2_context_trees,
        op3_pii,
        op4_ngram_join,
        op5_pieces,
        op6_mixing,
        op7_nearest,
        op8_sharding,
        op9_html,
        op10_lattice,
        op11_trie,
        op12_warc,
        op13_repair,
    )
}

SQL: dict[str, str] = {
    "op6_mixing": OP6_SQL,
    "op11_trie": OP11_SQL,
    "op12_warc": OP12_SQL,
    "op13_repair": OP13_SQL,
}
