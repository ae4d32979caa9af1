"""Fixed values.

Everything here must equal the published data format exactly, because content
ids, canonical rows and outcome names are computed from it.  Nothing in this
module is logic.
"""

from __future__ import annotations

# --- Fixed values: identity prefixes -------------------------------------------------
PUZZLE_ARTIFACT_PREFIX = "om.puzzle-artifact.sha256."
SOLUTION_PREFIX = "om.solution.sha256."
OBSERVATION_PREFIX = "om.observation.sha256."
VERIFICATION_PREFIX = "om.verification."
NORMALIZED_PREFIX = "om.normalized-solution."
DEFINITION_PREFIX = "om.puzzle-definition.sha256."
BENCHMARK_PREFIX = "om.benchmark."
RUN_PREFIX = "om.benchmark-run."
BENCHMARK_INVENTORY_PREFIX = "om.benchmark-inventory.sha256."
LOCAL_REVISION_PREFIX = "local-"

# --- Fixed values: versions and format names -----------------------------------------
DEFINITION_SCHEMA_VERSION = "puzzle-definition-v1"
NORMALIZER_VERSION = "opus-solution-v1"
SOLUTION_IMPORTER = "solution-materializer-v1"
PUZZLE_IMPORTER = "release-materializer-v1"
TOPOLOGY_IMPORTER = "molecule-db-semantic-v1"
OFFICIAL_REVISION_FORMAT = "official-game-source-revision/v2"
PUZZLE_TEXT_HEADER = "OPUS_MAGNUM_PUZZLE_TEXT_V2"
PUZZLE_TEXT_SERIALIZER = "opus-magnum-puzzle-text"
PUZZLE_TEXT_SERIALIZER_VERSION = "2"
CANDIDATE_COMPILER = "json-base64-solution"
CANDIDATE_COMPILER_VERSION = "1"
CANDIDATE_FORMAT = "om-solution-base64-v1"
ELIGIBILITY_PROFILE = "exact-output-solve-v0.1"
ELIGIBILITY_VERSION = "1"
PROTOCOL_VERSION = "solve-v0.1"
ATTEMPT_PROFILE = "bounded-sequential-v1"
SCORING_VERSION = "solve-report-v1"
RELEASE_FORMAT_VERSION = 2
PUZZLE_FORMAT = 3
SOLUTION_FORMAT = 7

# --- Fixed values: enumerations ------------------------------------------------------
# Conservative order: the highest rank wins when copies disagree.
RIGHTS_RANK = {"redistributable": 0, "unknown": 1, "local_fetch_only": 2}
SOURCE_PRIORITY = {"official-game": 0, "omsim": 1}
OTHER_SOURCE_PRIORITY = 2
PROTOCOL_PUZZLE_TYPES = ["normal", "polymer_height", "production"]
PUZZLE_TYPES = ["normal", "production", "polymer_height", "polymer_width", "polymer_skew"]
PUZZLE_KINDS = ["campaign", "production", "journal", "expansion", "custom", "tournament"]
STATUSES = ["not_run", "passed", "failed"]
PAYLOAD_POLICIES = ["metadata-only", "include-permitted"]
COVERAGE_POLICIES = ["complete", "subset"]
OUTCOMES = [
    "output_compile_failed",
    "solution_parse_failed",
    "puzzle_solution_mismatch",
    "simulation_failed",
    "success",
]
SOLUTION_VIEWS = ["all-verified", "vanilla-constructible", "record-eligible"]
SEMANTIC_FIELDS = [
    "allowed_parts",
    "allowed_instructions",
    "reagents",
    "products",
    "output_scale",
    "target_output_count",
    "production",
    "production_constraints",
]
INVENTORY_HEADER = [
    "puzzle_id",
    "display_name",
    "kind",
    "group",
    "game_puzzle_id",
    "leaderboard_key",
    "puzzle_type",
]

# --- Fixed values: patterns ----------------------------------------------------------
PUZZLE_ID_PATTERN = r"^om\.puzzle\.\d{4}$"
GROUP_PATTERN = r"^[a-z0-9]++(?:-[a-z0-9]++)*+$"
GAME_ID_PATTERN = r"^P\d{3}[a-z]?$"
LEADERBOARD_KEY_PATTERN = r"^[A-Z0-9_]+$"
SHA256_PATTERN = r"^[0-9a-f]{64}$"

# --- Fixed values: release tables: id column and canonical sort key ------------------
RELEASE_TABLES = {
    "puzzles": ("puzzle_id", ["puzzle_id"]),
    "solutions": ("solution_id", ["puzzle_id", "solution_id"]),
    "observations": ("observation_id", ["artifact_id", "observation_id"]),
    "normalized": ("normalized_solution_id", ["puzzle_id", "solution_id"]),
}

# --- Fixed values: upstream directory of each inventory group ------------------------
CAMPAIGN_DIRECTORIES = {
    "chapter-1": "CHAPTER_1",
    "chapter-2": "CHAPTER_2",
    "chapter-3": "CHAPTER_3",
    "chapter-4": "CHAPTER_4",
    "chapter-5": "CHAPTER_5",
    "appendix": "CHAPTER_PRODUCTION",
}
# The archive layout knows journal issues i to ix of the first journal only.
ARCHIVE_JOURNAL_ISSUES = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]
LEADERBOARD_JOURNAL_ISSUES = [
    "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii",
]
JOURNAL_GROUP_DIRECTORIES = {"journal-xcix-": "JOURNAL_", "journal-cviii-": "JOURNAL_CVIII_"}

# --- Fixed values: solution opcodes --------------------------------------------------
OPCODE_NAMES = {
    "R": "rotate_cw",
    "r": "rotate_ccw",
    "E": "extend",
    "e": "retract",
    "G": "grab",
    "g": "drop",
    "P": "pivot_cw",
    "p": "pivot_ccw",
    "A": "track_plus",
    "a": "track_minus",
    "C": "repeat",
    "X": "reset",
    "B": "halt",
    "O": "noop",
    " ": "noop",
}

# --- Fixed values: puzzle atoms, bonds and availability bits -------------------------
ATOM_TYPES = {
    1: "salt",
    2: "air",
    3: "earth",
    4: "fire",
    5: "water",
    6: "quicksilver",
    7: "gold",
    8: "silver",
    9: "copper",
    10: "iron",
    11: "tin",
    12: "lead",
    13: "vitae",
    14: "mors",
    15: "repeat",
    16: "quintessence",
    17: "variable",
}
BOND_BITS = {1: "normal", 2: "triplex-red", 4: "triplex-black", 8: "triplex-yellow"}
# Bit number that makes each part available.
PART_BITS = {
    "arm1": 0,
    "arm2": 1,
    "arm3": 1,
    "arm6": 1,
    "baron": 28,
    "bonder": 8,
    "bonder-prisma": 11,
    "bonder-speed": 10,
    "glyph-calcification": 12,
    "glyph-dispersion": 18,
    "glyph-disposal": 17,
    "glyph-division": 20,
    "glyph-duplication": 13,
    "glyph-life-and-death": 16,
    "glyph-marker": 1,
    "glyph-projection": 14,
    "glyph-proliferation": 21,
    "glyph-purification": 15,
    "glyph-rejection": 19,
    "glyph-unification": 18,
    "piston": 2,
    "ravari": 29,
    "track": 3,
    "unbonder": 9,
}
# Bit number of each instruction; None means always available.
INSTRUCTION_BITS = {
    "drop": 22,
    "extend": 2,
    "grab": 23,
    "halt": None,
    "noop": 25,
    "pivot_ccw": 26,
    "pivot_cw": 26,
    "repeat": 25,
    "reset": 24,
    "retract": 2,
    "rotate_ccw": 22,
    "rotate_cw": 22,
    "track_minus": 3,
    "track_plus": 3,
}

# --- Fixed values: decode bounds -----------------------------------------------------
PUZZLE_MAX_ITEMS = 100_000
PUZZLE_MAX_STRING = 1_048_576
SOLUTION_MAX_PARTS = 9_999
SOLUTION_MAX_INSTRUCTIONS = 99_999
SOLUTION_MAX_HEXES = 9_999
