"""Plan shapes shared by the operators: sliced scans, stored join sides, the shared folder."""

from harborlog.plans.bounded import Scratch, bounded, intermediate, stored
from harborlog.plans.shipping import ship
from harborlog.plans.sliced import SLICE_WIDTH, ranked, running_before, running_total, with_slice
from harborlog.plans.workspace import delete_folder, give_back_heap, new_folder, shared_folder

__all__ = [
    "SLICE_WIDTH",
    "Scratch",
    "bounded",
    "delete_folder",
    "give_back_heap",
    "intermediate",
    "new_folder",
    "ranked",
    "running_before",
    "running_total",
    "shared_folder",
    "ship",
    "stored",
    "with_slice",
]
