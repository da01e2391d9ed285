"""Schemas of the files between stages."""

from pyspark.sql import types as T

_URL = T.StructField("url", T.StringType())
RAW_PAGE = T.StructType([_URL, T.StructField("text", T.StringType())])
SECTION_PAGE = T.StructType([_URL, T.StructField("text_list", T.ArrayType(T.StringType()))])
SENTENCE_PAGE = T.StructType([_URL, T.StructField("text_list", T.ArrayType(T.ArrayType(T.StringType())))])
TOKEN_PAGE = T.StructType([_URL, T.StructField("text_list", T.ArrayType(T.ArrayType(T.ArrayType(T.StringType()))))])
LINK = T.StructType([_URL])
#: What stands in place of a section that was removed as a duplicate, so that positions stay.
DUPLICATE_MARK = "<DUPLICATE_REMOVED>"
