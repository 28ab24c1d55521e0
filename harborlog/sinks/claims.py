"""Claims on topic-partitions: of two queries that ingest the same one, the older fails before it commits.

A claim is a file ``<topic>/<partition>/<epoch>`` that names its owner. It is created only if there is none, and never changed. The
newest epoch owns the topic-partition.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from harborlog.sinks import paths


class Fenced(RuntimeError):
    """Another query has taken over a topic-partition, or has published what this batch was to publish."""


@dataclass
class Claims:
    root: str
    owner: str
    #: Owners that have been read; a claim never changes.
    _owners: dict[str, str] = field(default_factory=dict)

    def take(self, wanted: Iterable[tuple[str, int]]) -> None:
        """Claim what this owner never had. What it had and another owner has by now is lost for good."""
        for claimed, epochs in self._of(wanted).items():
            owners = [self._owner(claimed, epoch) for epoch in epochs]
            if owners and owners[-1] == self.owner:
                continue
            if self.owner in owners:
                raise Fenced(f"{owners[-1]} has taken over {claimed} from {self.owner}")
            epoch = epochs[-1] + 1 if epochs else 1
            if not paths.put_if_absent(self._path(claimed, epoch), self.owner.encode()):
                raise Fenced(f"another query claims {claimed} at this moment")

    def check(self, claimed: Iterable[tuple[str, int]]) -> None:
        """Fail unless this owner still has the newest claims."""
        for one, epochs in self._of(claimed).items():
            if not epochs or self._owner(one, epochs[-1]) != self.owner:
                raise Fenced(f"{self.owner} has lost {one}")

    def _of(self, claimed: Iterable[tuple[str, int]]) -> dict[tuple[str, int], list[int]]:
        """Epochs of topic-partitions, ascending; one listing per topic."""
        claimed = sorted(claimed)
        found: dict[tuple[str, int], list[int]] = {one: [] for one in claimed}
        for topic in {topic for topic, _ in claimed}:
            for name in paths.files_below(f"{self.root}/{topic}"):
                partition, _, epoch = name.rpartition("/")
                if epoch.isdigit() and (topic, int(partition)) in found:
                    found[topic, int(partition)].append(int(epoch))
        return {one: sorted(epochs) for one, epochs in found.items()}

    def _owner(self, claimed: tuple[str, int], epoch: int) -> str:
        path = self._path(claimed, epoch)
        if path not in self._owners:
            self._owners[path] = paths.read(path).decode()
        return self._owners[path]

    def _path(self, claimed: tuple[str, int], epoch: int) -> str:
        return f"{self.root}/{claimed[0]}/{claimed[1]}/{epoch:010d}"
