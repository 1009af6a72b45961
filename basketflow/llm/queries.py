"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from .bpe_replay import op9_byte_bpe
from .bpe_trie import op11_trie_bpe
from .collocations import OP12_SQL, op12_collocations
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .imatch import op6_document_fingerprints
from .licenses import op1_license_scan
from .ngram_join import op10_ngram_join
from .packing import op8_best_fit_packing
from .resample import op2_quality_classifier
from .sharding import op3_sharding
from .target_sampling import OP13_SQL, op13_target_sampling
from .token_counts import op7_token_counts
from .url_filter import op5_url_filter

REGISTRY = {
    q.__name__: q
    for q in (
        op1_license_scan,
        op2_quality_classifier,
        op3_sharding,
        op4_exact_dedup,
        op5_url_filter,
        op6_document_fingerprints,
        op7_token_counts,
        op8_best_fit_packing,
        op9_byte_bpe,
        op10_ngram_join,
        op11_trie_bpe,
        op12_collocations,
        op13_target_sampling,
    )
}
ORACLE = {"op4_exact_dedup": OP4_SQL, "op12_collocations": OP12_SQL, "op13_target_sampling": OP13_SQL}
