"""Column names, types and fixed values of the data model.

A recording is a session; a row is one frame of a session. Keypoints are rows of their own (one for each body part).
"""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: body parts in order
BODY_PARTS = ["Nose", "Left Ear", "Right Ear", "Neck", "Left Hip", "Right Hip", "TailBase", "TailTip"]
FRONT_PARTS = ["Nose", "Left Ear", "Right Ear", "Neck"]
REAR_PARTS = ["Left Hip", "Right Hip", "TailBase"]

# fixed values: skeleton edges
SKELETON = [
    ("Nose", "Left Ear"),
    ("Nose", "Right Ear"),
    ("Neck", "Left Ear"),
    ("Neck", "Right Ear"),
    ("Neck", "Left Hip"),
    ("Neck", "Right Hip"),
    ("TailBase", "Left Hip"),
    ("TailBase", "Right Hip"),
    ("TailBase", "TailTip"),
]

#: How far along the body a part lies; parts of one rank have no expected order from east to west.
BODY_RANK = [0, 1, 1, 2, 3, 3, 4]

# fixed values: camera and defaults
RESOLUTION = (512, 424)
FIELD_OF_VIEW = (70.6, 60.0)
TRUE_DEPTH = 673.1
CHUNK = 1000
FRAME_RATE = 30

SCALARS = [
    "centroid_x_px", "centroid_y_px", "velocity_2d_px", "velocity_3d_px", "width_px", "length_px", "area_px",
    "centroid_x_mm", "centroid_y_mm", "velocity_2d_mm", "velocity_3d_mm", "width_mm", "length_mm", "area_mm",
    "height_ave_mm", "angle", "velocity_theta",
]

FRAMES = T.StructType(
    [
        T.StructField("session", T.StringType(), False),
        T.StructField("frame_idx", T.LongType(), False),
        T.StructField("height", T.IntegerType(), False),
        T.StructField("width", T.IntegerType(), False),
        T.StructField("pixels", T.BinaryType(), False),
    ]
)
