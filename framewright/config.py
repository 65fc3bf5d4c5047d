"""Typed configuration, checked before anything runs."""

from __future__ import annotations

import copy
from pathlib import Path

# The configuration surface, section by section ("" is the top
# level), with its defaults.
KEYS = {
    "": {
        "dataset_path": "", "dataset_type": "auto", "camera_names": [], "stage": "both", "dry_run": False,
        "episode_indices": None, "frame_indices": None, "max_episodes": None, "max_frames_per_episode": None, "sample_frames_per_episode": None,
        "checkpoint_dir": None, "segmentation_checkpoint_dir": None, "depth_checkpoint_dir": None, "num_workers": 1, "log_level": "INFO",
    },
    "sampling": {"mode": "uniform", "frames_per_episode": None, "stride_frames": None, "stride_seconds": None, "keep_subtask_boundaries": True},
    "discovery": {
        "mode": "instruction", "extractor": "qwen", "always_include": ["robot hand"], "vocab_file": None, "manual_queries": {},
        "qwen_model_path": None, "qwen_endpoint": "http://localhost:8000/v1/chat/completions", "qwen_model": "qwen3-placeholder",
        "qwen_temperature": 0.0, "qwen_max_tokens": 128, "qwen_timeout": 30.0, "qwen_api_key": None,
        "instruction_source": "episode_field", "instruction_field": "expand_task", "instruction_join_path": None,
        "instruction_join_episode_key": "episode_index", "instruction_join_file_key": "episode_index",
        "instruction_join_text_field": "expand_task", "default_instruction": "",
    },
    "segmentation": {"model_path": None, "model_type": "sam3", "confidence_threshold": 0.5, "mask_threshold": 0.5, "max_instances_per_query": 10},
    "depth": {
        "model_path": None, "model_type": "depth_anything_v3", "output_metric": True, "debug_depth_range": False, "process_res": 504,
        "process_res_method": "upper_bound_resize", "use_ray_pose": False, "fx": None, "fy": None, "calibration_width": None, "calibration_height": None,
    },
    "storage": {"output_dir": "annotations", "segmentation_output_dir": None, "depth_output_dir": None, "mask_format": "parquet", "depth_format": "png16", "overwrite": False},
    "qc": {"enabled": True, "num_frames_per_episode": 5, "output_dir": None, "colormap": "turbo"},
}
CHOICES = {
    "dataset_type": ("auto", "lerobot_v3", "mock"), "stage": ("segmentation", "depth", "both"),
    "sampling.mode": ("uniform", "subtask_aware"), "discovery.mode": ("instruction", "vocab", "auto"),
    "discovery.extractor": ("qwen", "rule", "mock", "manual"), "discovery.instruction_source": ("episode_field", "join_file", "none"),
}

#: Keys that are read and checked but change nothing here: models are backends
#: that the caller gives, Spark schedules the work, and progress is read from
#: the products, so a checkpoint folder isn't needed.
WITHOUT_EFFECT = (
    "num_workers", "log_level", "checkpoint_dir", "segmentation_checkpoint_dir", "depth_checkpoint_dir", "discovery.mode", "discovery.vocab_file",
    "discovery.qwen_model_path", "segmentation.model_path", "segmentation.model_type", "segmentation.mask_threshold",
    "depth.model_path", "depth.model_type", "depth.debug_depth_range", "depth.process_res", "depth.process_res_method", "depth.use_ray_pose",
    "storage.mask_format", "storage.depth_format", "qc.enabled", "qc.output_dir", "qc.colormap",
)


class Section:
    """One section's values as attributes; unknown keys and values outside of
    CHOICES are errors."""

    def __init__(self, name: str, given: dict | None):
        known = KEYS[name]
        if unknown := set(given or {}) - set(known):
            raise ValueError(f"{name or 'configuration'}: unknown {', '.join(sorted(map(str, unknown)))}")
        for key, default in known.items():
            value = (given or {}).get(key, copy.deepcopy(default))
            allowed = CHOICES.get(f"{name}.{key}".lstrip("."))
            if allowed and value not in allowed:
                raise ValueError(f"{name}.{key}: {value!r} is none of {', '.join(allowed)}")
            setattr(self, key, value)


class SamplingConfig(Section):
    """The sampling section; the counts and lists of the top level that go with
    it, and the frame rate once it is known."""

    def __init__(self, fps: float | None = None, frame_indices=None, sample_frames_per_episode=None, max_frames_per_episode=None, **given):
        super().__init__("sampling", given)
        self.fps, self.frame_indices = fps, frame_indices
        self.sample_frames_per_episode, self.max_frames_per_episode = sample_frames_per_episode, max_frames_per_episode
        if self.mode == "subtask_aware" and (self.stride_frames is None) == (self.stride_seconds is None):
            raise ValueError("sampling: give stride_frames or stride_seconds, one of them")
        if any(x is not None and x <= 0 for x in (self.stride_frames, self.stride_seconds)):
            raise ValueError("sampling: the stride must be positive")
        for name in ("frames_per_episode", "sample_frames_per_episode", "max_frames_per_episode"):
            if (getattr(self, name) or 0) < 0:
                raise ValueError(f"sampling: {name} must not be negative")

    def uniform_count(self) -> int | None:
        return self.sample_frames_per_episode if self.frames_per_episode is None else self.frames_per_episode

    def stride(self) -> int | None:
        """Frames between two samples, or None if that takes each episode's
        own frame rate."""
        if self.stride_frames is not None:
            return self.stride_frames
        if not self.fps:
            return None
        stride = round(self.stride_seconds * self.fps)  # half to even
        if stride < 1:
            raise ValueError("sampling: the stride is below one frame")
        return stride


class PipelineConfig(Section):
    """The whole configuration: the top level's values, and a section each."""

    def __init__(self, **given):
        parts = {name: given.pop(name, None) or {} for name in KEYS if name}
        super().__init__("", given)
        for name in ("discovery", "segmentation", "depth", "storage", "qc"):
            setattr(self, name, Section(name, parts[name]))
        counts = {k: getattr(self, k) for k in ("frame_indices", "sample_frames_per_episode", "max_frames_per_episode")}
        self.sampling = SamplingConfig(**counts, **parts["sampling"])

    def folder(self, product: str) -> str:
        """The product's own folder, or one below the common one, so that runs
        of one stage never write to the same place."""
        own = {"masks": ("segmentation_output_dir", "segmentation"), "depth": ("depth_output_dir", "depth_stage")}[product]
        return str(getattr(self.storage, own[0]) or f"{self.storage.output_dir}/{own[1]}")


def load_config(path: str | Path) -> PipelineConfig:
    import yaml

    return PipelineConfig(**(yaml.safe_load(Path(path).read_text()) or {}))
