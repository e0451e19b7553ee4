"""The queries of this subpackage and their SQL."""

from tidewell.llm.centroids import OP11_SQL, op11_centroids
from tidewell.llm.decontaminate import op8_decontaminate
from tidewell.llm.main_text import op3_main_text
from tidewell.llm.mixing import OP12_SQL, op12_mixture
from tidewell.llm.near_dups import op7_near_dups
from tidewell.llm.near_vectors import op4_near_vectors
from tidewell.llm.oracles import OP4_SQL, OP7_SQL, OP8_SQL
from tidewell.llm.periodic import op13_periodic_runs
from tidewell.llm.pii import op2_pii
from tidewell.llm.piece_codec import op10_piece_codec
from tidewell.llm.preference import OP5_SQL, TURNS_SQL, given_turns, op5_preference
from tidewell.llm.quality import op9_quality
from tidewell.llm.sharding import op6_sharding
from tidewell.llm.token_store import op1_token_store

QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_pii": op2_pii,
    "op3_main_text": op3_main_text,
    "op4_near_vectors": op4_near_vectors,
    "op5_preference": op5_preference,
    "op6_sharding": op6_sharding,
    "op7_near_dups": op7_near_dups,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_piece_codec": op10_piece_codec,
    "op11_centroids": op11_centroids,
    "op12_mixture": op12_mixture,
    "op13_periodic_runs": op13_periodic_runs,
    "preference_turns": given_turns,
}

ORACLE_SQL: dict[str, str] = {
    "op4_near_vectors": OP4_SQL,
    "op5_preference": OP5_SQL,
    "op7_near_dups": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
    "op11_centroids": OP11_SQL,
    "op12_mixture": OP12_SQL,
    "preference_turns": TURNS_SQL,
}
