"""The one check that every path of a source or sink passes."""

from __future__ import annotations

import re

#: File systems whose authority may be a host with a port; in all others a colon there has no meaning.
HOST_SCHEMES = {"hdfs", "webhdfs", "swebhdfs", "viewfs", "file", "ftp", "sftp", "http", "https", "alluxio"}
_URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*)://(.*)$", re.DOTALL)
_PORT = re.compile(r":\d*$")
#: Signed links carry their secret behind the question mark.
_SIGNED = re.compile(r"[?&](sig|signature|x-amz-signature|x-amz-security-token|x-goog-signature|awsaccesskeyid|token|secret|password)=", re.IGNORECASE)
REFUSAL = "credentials belong in the Hadoop configuration, not in the path"


def carries_credentials(path: str) -> bool:
    """Whether a path holds a password or secret, also one that was not escaped and so holds slashes.

    A colon before an ``@`` is a user with a password. Where the secret has a slash, the authority
    ends within it, and what follows its colon is no port.
    """
    match = _URI.match(path)
    if not match:
        return False
    scheme, rest = match[1].lower(), match[2]
    authority = re.split(r"[/?#]", rest, maxsplit=1)[0]
    user, at, host = authority.rpartition("@")
    if at and ":" in user:
        return True
    if ":" in host and not (scheme in HOST_SCHEMES and _PORT.search(host) and host.count(":") == 1 or host.startswith("[")):
        return True
    return bool(_SIGNED.search(rest))


def checked(path: str) -> str:
    """``path``, if it carries no credentials; the refusal does not repeat them."""
    if carries_credentials(path):
        raise ValueError(REFUSAL)
    return path
