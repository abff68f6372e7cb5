"""Operators for training-data pipelines and their registered queries."""

from .alignment import op13_arrow_alignment
from .chat import OP2_SQL, op2_schema_fingerprints
from .decontamination import op8_pigeonhole
from .middle_frames import OP11_SQL, op11_seekable_frames
from .near_vectors import OP7_SQL, op7_small_worlds
from .ngram_join import OP1_SQL, op1_prefix_tree
from .packing import op10_power_of_two
from .pii import op6_disclosure
from .rank_bpe import op12_backtracking
from .repeats import op5_merged_transforms
from .resharding import op3_flow_resharding
from .token_files import op4_bit_planes
from .toxicity import op9_kneser_ney

QUERIES = {f.__name__: f for f in (op1_prefix_tree, op2_schema_fingerprints, op3_flow_resharding, op4_bit_planes, op5_merged_transforms, op6_disclosure, op7_small_worlds, op8_pigeonhole, op9_kneser_ney, op10_power_of_two, op11_seekable_frames, op12_backtracking, op13_arrow_alignment)}
CHECKS: dict[str, str] = {"op1_prefix_tree": OP1_SQL, "op2_schema_fingerprints": OP2_SQL, "op7_small_worlds": OP7_SQL, "op11_seekable_frames": OP11_SQL}
