"""Training-data operators (secrets, digests, WARC, mixing, packing, token
files, near duplicates, quality, main text, licences). Nothing else in the
library imports this subpackage."""
