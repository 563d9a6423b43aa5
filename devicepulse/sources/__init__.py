from devicepulse.sources.artefacts import load_classifier, load_scaler, save_artefact
from devicepulse.sources.manifest import load_manifest, save_manifest, without_target
from devicepulse.sources.tables import read_table, write_scores, write_table
from devicepulse.sources.versions import Buckets, commit_table, current_version, read_current, read_version
from devicepulse.sources.workspace import pin, scratch_path, shared_folder

__all__ = [
    "Buckets",
    "commit_table",
    "current_version",
    "read_current",
    "read_version",
    "load_classifier",
    "load_manifest",
    "load_scaler",
    "pin",
    "read_table",
    "save_artefact",
    "save_manifest",
    "scratch_path",
    "shared_folder",
    "without_target",
    "write_scores",
    "write_table",
]
