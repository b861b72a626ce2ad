"""AES-GCM at the storage boundary: nonce (12 bytes), ciphertext, tag (16 bytes)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

OVERHEAD = 28


def encrypt_bytes(plain: Column, key: bytes) -> Column:
    return F.aes_encrypt(plain, F.lit(key), F.lit("GCM"))


def decrypt_bytes(cipher: Column, key: bytes) -> Column:
    """Fails the task on a bad tag."""
    return F.aes_decrypt(cipher, F.lit(key), F.lit("GCM"))


def try_decrypt_bytes(cipher: Column, key: bytes) -> Column:
    """NULL on a bad tag or a value too short to hold nonce and tag."""
    return F.try_aes_decrypt(cipher, F.lit(key), F.lit("GCM"))


def seal(text: Column, key: bytes) -> Column:
    """Text to base64 ciphertext, the form in which tables hold content."""
    return F.base64(encrypt_bytes(text.cast("binary"), key))


def unseal(sealed: Column, key: bytes) -> Column:
    return decrypt_bytes(F.unbase64(sealed), key).cast("string")
