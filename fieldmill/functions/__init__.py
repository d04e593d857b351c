from fieldmill.functions.arrays import array_mean, array_sum, element_count
from fieldmill.functions.calendar import date_from_parts, day_name, epoch_to_timestamp
from fieldmill.functions.delays import is_later, majority_label, timing_label, timing_label_udf
from fieldmill.functions.text import clean_chars, clean_name, quoted, route_label
from fieldmill.functions.xml import infer_xml_schema, parse_xml

__all__ = [
    "array_mean",
    "array_sum",
    "clean_chars",
    "clean_name",
    "date_from_parts",
    "day_name",
    "element_count",
    "epoch_to_timestamp",
    "infer_xml_schema",
    "is_later",
    "majority_label",
    "parse_xml",
    "quoted",
    "route_label",
    "timing_label",
    "timing_label_udf",
]
