"""Column functions: vector maths and point records."""

from .points import (LABELLED_SCHEMA, PALETTE, POINT_SCHEMA, assemble_features,
                     features_to_xy, label_color, label_points, parse_labelled,
                     parse_points, parse_valid_points, points_to_json, rejected_points,
                     split_points, valid_points)
from .vectors import (is_finite_vector, to_array, to_dense, to_double_array,
                      to_vector, vec_add, vec_axpy, vec_dot, vec_norm,
                      vec_scale, vec_sqdist, vec_sqdist_lower_bound, vec_zeros)

__all__ = [
    "LABELLED_SCHEMA", "PALETTE", "POINT_SCHEMA", "assemble_features",
    "features_to_xy", "label_color", "label_points", "parse_labelled",
    "parse_points", "parse_valid_points", "points_to_json", "rejected_points", "split_points",
    "valid_points", "is_finite_vector", "to_array", "to_dense",
    "to_double_array", "to_vector", "vec_add", "vec_axpy", "vec_dot",
    "vec_norm", "vec_scale", "vec_sqdist", "vec_sqdist_lower_bound",
    "vec_zeros",
]
