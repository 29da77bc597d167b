"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from . import (
    bpe, crosspolytope, filteraudit, language, linededup, mixing, ngramjoin, passages, sharding,
    tokenfst, topk, urls, vectorcodes,
)

QUERIES = {fn.__name__: fn for fn in (
    topk.op1_topk, language.op2_language_id, urls.op3_url_filters, mixing.op4_mixing,
    tokenfst.op5_token_counts, bpe.op6_bpe, ngramjoin.op7_ngram_join,
    passages.op8_substring_dedup, sharding.op9_sharding, crosspolytope.op10_embedding_dedup,
    vectorcodes.op11_vector_codes, linededup.op12_line_dedup, filteraudit.op13_filter_audit,
)}

ORACLES = {"op1_topk": topk.OP1_SQL, "op4_mixing": mixing.OP4_SQL,
           "op11_vector_codes": vectorcodes.OP11_SQL, "op12_line_dedup": linededup.OP12_SQL,
           "op13_filter_audit": filteraudit.OP13_SQL}
