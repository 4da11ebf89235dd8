"""Poses, cameras, kinematic chains, and the fixed 128-place layouts of states and actions."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.functions.vectors import pad

# Places of an arm's blocks in the layouts, and of what they hold.
STATE_ARM, ACTION_ARM, JOINTS, POSE, ROTATION, HAND, WIDTH = 35, 34, 7, 7, 3, 21, 128
SIMPLE_GRIPPERS = ("parallel_jaw", "three_jaw", "cage_pinch", "suction")


def place(v: Column, i: int) -> Column:
    return F.get(v, F.lit(i))


def rotation_matrix(rows: Sequence[Sequence[float]]) -> np.ndarray:
    """The nearest proper rotation to a 3x3 matrix."""
    u, _, vt = np.linalg.svd(np.asarray(rows, float).reshape(3, 3))
    return u @ np.diag([1, 1, np.sign(np.linalg.det(u @ vt))]) @ vt


def quaternion_of(r: np.ndarray) -> np.ndarray:
    """x, y, z, w of a rotation matrix, w not negative."""
    k = np.array([[r[0, 0] - r[1, 1] - r[2, 2], 0, 0, 0], [r[1, 0] + r[0, 1], r[1, 1] - r[0, 0] - r[2, 2], 0, 0], [r[2, 0] + r[0, 2], r[2, 1] + r[1, 2], r[2, 2] - r[0, 0] - r[1, 1], 0], [r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1], r.trace()]])
    q = np.linalg.eigh((k + np.tril(k, -1).T) / 3)[1][:, -1]
    return q if q[3] >= 0 else -q


def transform_point(p: Column, rotation: np.ndarray, shift: Sequence[float]) -> Column:
    """A rotated and shifted point, in the JVM."""
    return F.array(*(sum((place(p, j) * float(rotation[i][j]) for j in range(3)), F.lit(float(shift[i]))) for i in range(3)))


def multiply(a: Column, b: Column) -> Column:
    """Product of two quaternions (x, y, z, w)."""
    ax, ay, az, aw = (place(a, i) for i in range(4))
    bx, by, bz, bw = (place(b, i) for i in range(4))
    return F.array(aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz)


def length(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def unit(v: Column) -> Column:
    return F.transform(v, lambda x: F.try_divide(x, length(v)))


def inverse(q: Column) -> Column:
    return F.array(-place(q, 0), -place(q, 1), -place(q, 2), place(q, 3))


def rotation_vector(q: Column) -> Column:
    """The shortest rotation as axis times angle."""
    u = unit(q)
    flip = F.when(place(u, 3) < 0, -1.0).otherwise(1.0)
    size = length(F.slice(u, 1, 3))
    angle = 2 * F.atan2(size, place(u, 3) * flip)
    scale = F.when(size < 1e-7, 2.0).otherwise(F.try_divide(angle, size)) * flip
    return F.transform(F.slice(u, 1, 3), lambda x: x * scale)


def align_pose(pose: Column, rotation: np.ndarray, shift: Sequence[float]) -> Column:
    """A pose (position, quaternion) seen from another frame; null if the quaternion has no direction."""
    q = F.slice(pose, 4, 4)
    world = F.array(*(F.lit(float(x)) for x in quaternion_of(rotation)))
    fine = (length(q) > 1e-8) & ~F.isnan(length(q)) & (length(q) < float("inf"))
    return F.when(fine, F.concat(transform_point(F.slice(pose, 1, 3), rotation, shift), multiply(world, q)))


def pixel(point: Column, extrinsics: np.ndarray, intrinsics: Sequence[float]) -> Column:
    """Pixel (u, v) of a point through a pinhole camera (fx, fy, cx, cy); null behind the camera."""
    m = np.asarray(extrinsics, float).reshape(4, 4)
    c = transform_point(point, m[:3, :3], m[:3, 3])
    fx, fy, cx, cy = map(float, intrinsics)
    return F.when(place(c, 2) > 0, F.array(place(c, 0) / place(c, 2) * fx + cx, place(c, 1) / place(c, 2) * fy + cy))


def disk(u: float, v: float, radius: float, height: int, width: int) -> np.ndarray:
    """Pixels within a radius (1 at least) of a point."""
    y, x = np.mgrid[:height, :width]
    return (x - u) ** 2 + (y - v) ** 2 <= max(1.0, radius) ** 2


def _hand(cols: Column, gripper: str) -> tuple[Column, int]:
    n = 1 if gripper in SIMPLE_GRIPPERS else HAND if gripper == "dexterous_hand" else 0
    return pad(F.slice(cols, 1, n) if n else F.array().cast("array<double>"), HAND), n


def _from(v: Column, start: int) -> Column:
    """Elements from a 0-based place on."""
    return F.slice(v, start + 1, WIDTH)


def pack_state(state: Column, width: int, dof: int, arms: int = 1, gripper: str = "unknown") -> tuple[Column, list[bool]]:
    """(128 places, which of them are filled) for states of `width` places: for each arm joints, pose, gripper.

    An arm has a pose if it has room for joints, pose and at least one more place.
    """
    arms, dof = max(1, min(arms, 2)), max(dof, 0)
    per = width // arms
    blocks, mask = [], []
    for i in range(arms):
        arm = F.slice(state, i * per + 1, per)
        joints = min(dof, JOINTS, per)
        pose = POSE if per >= dof + POSE + 1 else 0
        rest = dof + POSE if pose else min(dof, per)
        hand, n = _hand(_from(arm, rest), gripper)
        n = min(n, max(0, per - rest))
        blocks += [pad(F.slice(arm, 1, joints), JOINTS), pad(F.slice(arm, dof + 1, POSE) if pose else F.array().cast("array<double>"), POSE), hand]
        mask += [x < joints for x in range(JOINTS)] + [bool(pose)] * POSE + [x < n for x in range(HAND)]
    return pad(F.concat(*blocks), WIDTH), mask + [False] * (WIDTH - len(mask))


def pack_action(action: Column, state: Column, width: int, state_width: int, dof: int, arms: int = 1, gripper: str = "unknown", space: str = "joint_position", frame: str = "delta") -> tuple[Column | None, list[bool], str | None]:
    """(128 places, which are filled, reason for skipping) for actions: for each arm joints, position, rotation, gripper.

    The second arm begins at place 34, place 68 stays empty. Absolute actions become differences to the state. Joint
    actions leave the pose empty; `forward_pose` gives it where a kinematic chain is known.
    """
    if space not in ("eef_pose", "joint_position"):
        return None, [], "action_space_not_supported"
    if frame not in ("delta", "absolute"):
        return None, [], "action_frame_not_supported"
    arms, dof = max(1, min(arms, 2)), max(dof, 0)
    per, state_per = width // arms, state_width // arms
    empty = F.array().cast("array<double>")
    blocks, mask = [], []
    for i in range(arms):
        arm, body = F.slice(action, i * per + 1, per), F.slice(state, i * state_per + 1, state_per)
        if space == "joint_position":
            n = min(dof, JOINTS, per)
            joints = F.slice(arm, 1, n)
            if frame == "absolute":
                joints = F.zip_with(joints, F.slice(body, 1, n), lambda a, s: a - s)
            position = rotation = empty
            moved, rest = 0, dof
        else:
            n, joints, moved, rest = 0, empty, 3, POSE
            position, quaternion = F.slice(arm, 1, 3), F.slice(arm, 4, 4)
            if frame == "absolute":
                position = F.zip_with(position, F.slice(body, dof + 1, 3), lambda a, s: a - s)
                quaternion = multiply(unit(quaternion), inverse(unit(F.slice(body, dof + 4, 4))))
            rotation = rotation_vector(quaternion)
        hand, g = _hand(_from(arm, rest), gripper)
        blocks += [pad(joints, JOINTS), pad(position, 3), pad(rotation, ROTATION), hand]
        mask += [x < n for x in range(JOINTS)] + [bool(moved)] * (3 + ROTATION) + [x < min(g, max(0, per - rest)) for x in range(HAND)]
    return pad(F.concat(*blocks), WIDTH), mask + [False] * (WIDTH - len(mask)), None


def bands(canonical: Column, action: bool = False) -> dict[str, Column]:
    """The named parts of the layout, by arm."""
    arm, parts = (ACTION_ARM, (("joint", JOINTS), ("position", 3), ("rotation", ROTATION), ("gripper", HAND))) if action else (STATE_ARM, (("joint", JOINTS), ("pose", POSE), ("gripper", HAND)))
    out = {}
    for i in range(2):
        at = i * arm
        for name, n in parts:
            out[f"arm{i + 1}_{name}"] = F.slice(canonical, at + 1, n)
            at += n
    reserve = 69 if action else 2 * STATE_ARM
    return out | {"reserve": F.slice(canonical, reserve + 1, WIDTH - reserve)}


@dataclass(frozen=True)
class Joint:
    name: str
    kind: str
    origin: np.ndarray
    axis: np.ndarray


def _euler(rpy: Sequence[float]) -> np.ndarray:
    (cr, cp, cy), (sr, sp, sy) = np.cos(rpy), np.sin(rpy)
    return np.array([[cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr], [sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr], [-sp, cp * sr, cp * cr]])


class Chain:
    """Joints of a URDF from its root to the tip (the deepest last link unless one is named)."""

    def __init__(self, text: str, tip: str | None = None) -> None:
        numbers = lambda e, k, d: np.array([float(x) for x in (e.get(k) if e is not None and e.get(k) else d).split()])
        by_child = {j.find("child").get("link"): j for j in ET.fromstring(text).iter("joint") if j.find("child") is not None}
        if tip is None:
            inner = {j.find("parent").get("link") for j in by_child.values()}
            tip = max((c for c in by_child if c not in inner), key=lambda c: len(self._path(by_child, c)))
        self.joints = []
        for j in self._path(by_child, tip):
            o, m = j.find("origin"), np.eye(4)
            m[:3, :3], m[:3, 3] = _euler(numbers(o, "rpy", "0 0 0")), numbers(o, "xyz", "0 0 0")
            axis = numbers(j.find("axis"), "xyz", "1 0 0")
            self.joints.append(Joint(j.get("name"), j.get("type"), m, axis / np.linalg.norm(axis)))
        self.active = [j for j in self.joints if j.kind in ("revolute", "continuous", "prismatic")]

    @staticmethod
    def _path(by_child: dict, link: str) -> list:
        out = []
        while link in by_child:
            out.insert(0, by_child[link])
            link = by_child[link].find("parent").get("link")
        return out

    def forward(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, rotations) of the tip for [frames, joints]."""
        q = np.atleast_2d(q)
        m, k = np.broadcast_to(np.eye(4), (len(q), 4, 4)).copy(), 0
        for j in self.joints:
            m = m @ j.origin
            if j in self.active:
                step = np.broadcast_to(np.eye(4), m.shape).copy()
                if j.kind == "prismatic":
                    step[:, :3, 3] = q[:, k, None] * j.axis
                else:
                    x, y, z = j.axis
                    a = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
                    s, c = np.sin(q[:, k])[:, None, None], np.cos(q[:, k])[:, None, None]
                    step[:, :3, :3] = np.eye(3) + s * a + (1 - c) * (a @ a)
                m, k = m @ step, k + 1
        return m[:, :3, 3], m[:, :3, :3]


def forward_pose(urdf: str, joints: Column, tip: str | None = None) -> Column:
    """Pose (position, quaternion) of the tip from joint positions, over Arrow batches; null for too few joints."""
    chain = Chain(urdf, tip)
    n = len(chain.active)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(rows: pd.Series) -> pd.Series:
        ok = [i for i, x in enumerate(rows) if x is not None and len(x) >= n]
        out: list = [None] * len(rows)
        if ok:
            p, r = chain.forward(np.stack([np.asarray(rows.iloc[i], float)[:n] for i in ok]))
            for i, a, b in zip(ok, p, r):
                out[i] = [*a.tolist(), *quaternion_of(b).tolist()]
        return pd.Series(out)

    return run(joints)
