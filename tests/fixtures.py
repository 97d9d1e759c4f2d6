"""Known inputs and results."""

from __future__ import annotations

# A key, a value, and its digests.
KEY = "4BAC2739-3BDD-9777-CE02453256C5"
VALUE = "sample key"
DIGESTS = {
    "hash-adler32": "351011a3",
    "hash-crc32": "b111d10f",
    "hash-crc32c": "811b3682",
    "hash-farmHashFingerprint64": "ab9162eb3439a9a3",
    "hash-sha256": "e0017d72714affa14ee435f57450d4364d2161e2f0abf90019964f1263c1d073",
    "hash-sha384": "5a4ff1e6db9cc4859b011a69e32df10d6dec7a3146aee02f9865fea081d2a501"
    "6584377956a164579f2a0dba869da78d",
    "hash-sha512": "cd9d9b85532f02fb977a2742d4c0b388aa317007feb8809e6e58059424a0048e"
    "af0e062e32d12510a006409f58ee664d119d12ee0d75e71d1a84b18c574104ef",
}
SHA256_123_FOO_WAY = "3763dc3aa103d838243f7a585a498c380fd373577538b3bd7c00b2a1aa72e57a"
SHA512_123_FOO_WAY = (
    "6795911664a56c00c0b4a416d0ef199df40ab4b83160246df48fcf00826a97ab"
    "1a453fe5b0448795d64739c61771caefb9de89c2607cbb0b21887e2279fe5b3b"
)
SHA256_123_ADDRESS = "ebb59f4d65174fa86f81d0b37f2ee2d3d6dff4f1ccebc303416cf78e488a083e"
# The digest of VALUE when the key is the text "null".
SHA256_NULL_KEY = "620a8a34c1f06d4707c12d30c7d20a3b7e9f4d166bbeb28ad5a272883eee0bc5"

# Further digests with the same key.
MORE_DIGESTS = {
    "a": ("52084295", "dc94a77f", "408bb2ac", "35697f2775f03843"),
    "\u00e9": ("8e098ca2", "9e9f7d7c", "120d6a7b", "c8a4c58f2376741e"),
    "x" * 100: ("3661e894", "f8f125e9", "46f8b09c", "20f4254740f1a8ab"),
}
MORE_ALGORITHMS = ("adler32", "crc32", "crc32c", "farmHashFingerprint64")
