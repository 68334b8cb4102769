"""Configuration of a dataset: what to map, at which rate, and how to write."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field

#: What a mapped topic may be.
TYPES = ("image", "state", "action", "timestamp", "othersensor", "audio", "camerainfo")
MIB, GIB = 1 << 20, 1 << 30
#: Encoder presets as (speed, constant rate factor).
PROFILES = {"speed": ("ultrafast", 28), "balanced": ("medium", 23), "quality": ("slow", 18), "storage": ("slow", 28), "prototype": ("ultrafast", 32)}


@dataclass(frozen=True)
class Mapping:
    topic: str
    feature: str
    type: str = "state"

    @property
    def camera(self) -> str:
        return self.feature.rsplit(".", 1)[-1]


@dataclass(frozen=True)
class Config:
    name: str
    fps: int = 30
    robot_type: str | None = None
    mappings: tuple[Mapping, ...] = ()
    codec: str = "libx264"
    crf: int = 18
    profile: str | None = None
    max_frames: int | None = None
    per_chunk: int = 500
    mode: str = "floor"
    emit: str = "per_bucket"
    gap_ns: int | None = None
    frames_per_episode: int | None = None
    ring_buffer: int = 128
    part_bytes: int = 16 * MIB
    window_frames: int = 3
    required: tuple[str, ...] = field(default=())
    flush_images: int = 1000
    flush_bytes: int = 2 * GIB

    def __post_init__(self) -> None:
        faults = [
            (not self.name.strip(), "name is empty"),
            (self.fps <= 0, "fps must be positive"),
            (not 0 <= self.crf <= 51, "crf must be in 0..51"),
            (self.ring_buffer <= 0, "ring_buffer must be positive"),
            (not 5 * MIB <= self.part_bytes <= 5 * GIB, "part_bytes must be in 5 MiB..5 GiB"),
            (len({m.topic for m in self.mappings}) != len(self.mappings), "a topic is mapped twice"),
            (any(m.type not in TYPES for m in self.mappings), f"mapping types are {', '.join(TYPES)}"),
            (self.profile is not None and self.profile not in PROFILES, f"profiles are {', '.join(PROFILES)}"),
            (self.mode not in ("floor", "round"), "mode is floor or round"),
            (self.emit not in ("per_bucket", "per_message"), "emit is per_bucket or per_message"),
            (self.gap_ns is not None and self.frames_per_episode is not None, "one way to cut episodes at a time"),
        ]
        for bad, what in faults:
            if bad:
                raise ValueError(what)

    def of_type(self, kind: str) -> list[Mapping]:
        return [m for m in self.mappings if m.type == kind]

    def should_flush(self, images: int, held_bytes: int) -> bool:
        return should_flush(images, held_bytes, self.flush_images, self.flush_bytes)

    def encoder(self) -> tuple[str, int]:
        return PROFILES[self.profile] if self.profile else ("medium", self.crf)


def from_toml(text: str) -> Config:
    """[dataset] name, fps, robot_type; [[mappings]] topic, feature, mapping_type; [video]; [streaming] ring_buffer, part_bytes, mode,

    emit, max_frames, gap_ns, frames_per_episode, window_frames, required; [flushing] max_images, max_bytes. Unknown keys are passed over.
    """
    raw = tomllib.loads(text)
    data, video, more = raw.get("dataset", {}), raw.get("video", {}), raw.get("streaming", {})
    maps = tuple(Mapping(m["topic"], m["feature"], m.get("mapping_type", m.get("type", "state")).lower()) for m in raw.get("mappings", []))
    names = ("ring_buffer", "part_bytes", "mode", "emit", "max_frames", "gap_ns", "frames_per_episode", "window_frames")
    known = {k: more[k] for k in names if k in more}
    known["required"] = tuple(more.get("required", ()))
    known |= {own: raw["flushing"][k] for own, k in (("flush_images", "max_images"), ("flush_bytes", "max_bytes")) if k in raw.get("flushing", {})}
    return Config(data["name"], data.get("fps", 30), data.get("robot_type"), maps, video.get("codec", "libx264"), video.get("crf", 18), video.get("profile"), **known)


def should_flush(images: int, held_bytes: int, most_images: int = 1000, most_bytes: int = 2 * GIB) -> bool:
    """0 switches a limit off."""
    return bool(most_images and images >= most_images or most_bytes and held_bytes >= most_bytes)
