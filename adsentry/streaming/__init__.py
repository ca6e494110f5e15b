"""The count operators over ``readStream`` sources."""
