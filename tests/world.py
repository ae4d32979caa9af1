"""A small landed world on disk: inventory, receipts, objects, puzzles, solutions and metadata."""

import hashlib
import json

from test_binary import part, puzzle, solution

HEADER = "puzzle_id,display_name,kind,group,game_puzzle_id,leaderboard_key,puzzle_type"
ROWS = [
    "om.puzzle.0001,Stabilized Water,campaign,chapter-1,P007,STABILIZED_WATER,normal",
    'om.puzzle.0002,"Rust, Gold",campaign,chapter-2,P010,REFINED_GOLD,normal',
    "om.puzzle.0003,Tincture,journal,journal-xcix-ii,P050,TINCTURE,polymer_width",
]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def py_json(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


class World:
    def __init__(self, root):
        self.root = root
        self.puzzles = {p: puzzle(name=p) for p in ("P007", "P010", "P050")}

    def land(self, source, revision, path, data, rights="local_fetch_only", at="2026-01-01T00:00:00Z"):
        digest = sha(data)
        target = self.root / "objects" / "sha256" / digest[:2] / digest[2:]
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
        record = {
            "source_id": source, "revision": revision, "upstream_path": path, "sha256": digest, "byte_length": len(data),
            "rights_status": rights, "retrieved_at": at,
        }
        name = hashlib.sha256(f"{source}\0{revision}\0{path}".encode()).hexdigest()
        folder = self.root / "receipts" / source / revision
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text(py_json(record) + "\n")
        return digest

    def inventory(self, rows=ROWS, header=HEADER):
        path = self.root / "inventory.csv"
        path.write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")
        return str(path)

    def official(self):
        entries = [("om.puzzle.0001", "P007"), ("om.puzzle.0002", "P010"), ("om.puzzle.0003", "P050")]
        mappings = [
            {"puzzle_id": i, "path": f"puzzles/{g}.puzzle", "payload_sha256": sha(self.puzzles[g]), "payload_bytes": len(self.puzzles[g])}
            for i, g in entries
        ]
        commitment = {"format": "official-game-source-revision/v2", "snapshot_id": "snap", "mappings": mappings}
        revision = "local-" + sha(py_json(commitment).encode())
        toml = 'snapshot_id = "snap"\n' + "".join(f'\n[[puzzles]]\npuzzle_id = "{i}"\npath = "puzzles/{g}.puzzle"\n' for i, g in entries)
        self.land("official-game", revision, "official-puzzles.toml", toml.encode())
        for _, g in entries:
            self.land("official-game", revision, f"puzzles/{g}.puzzle", self.puzzles[g])
        return revision

    def fill(self):
        """Two exact copies of one solution, paired, unpaired and linked metadata, one fixture copy."""
        self.official()
        self.land("omsim", "r1", "test/puzzle/campaign/P007.puzzle", self.puzzles["P007"], "redistributable")
        self.land("omsim", "r1", "test/puzzle/other/P010.puzzle", b"ignored")
        arm = part("arm1", steps=[(0, "G"), (1, "g")])
        self.one, self.two, self.three = (solution([arm], "P007", (9, 8, 7, 6)), solution([arm, arm], "P010"), solution([], "P050"))
        self.land("om-archive", "a1", "CHAPTER_1/STABILIZED_WATER/x.solution", self.one, "redistributable")
        self.land("om-leaderboard", "l1", "CHAPTER_1/STABILIZED_WATER/y.solution", self.one, "redistributable")
        self.land("om-leaderboard", "l1", "CHAPTER_2/REFINED_GOLD/z.solution", self.two)
        self.land("om-leaderboard", "l1", "JOURNAL_II/TINCTURE/t.solution", self.three)
        self.land("om-leaderboard", "l1", "CHAPTER_9/UNKNOWN/u.solution", b"not ours")
        paired = {"score": {"cost": 20, "cycles": 40, "area": None}, "dataLink": "https://l/1", "puzzle": "STABILIZED_WATER", "dataPath": "y.solution"}
        self.land("om-leaderboard", "l1", "CHAPTER_1/STABILIZED_WATER/y.json", py_json(paired).encode())
        unpaired = {"displayLink": "https://l/2", "dataPath": "gone.solution"}
        self.land("om-leaderboard", "l1", "CHAPTER_2/REFINED_GOLD/gone.json", py_json(unpaired).encode())
        return self
