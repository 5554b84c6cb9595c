"""End-to-end flows composed from the operators (profile A, profile B, SME)."""
