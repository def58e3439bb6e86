"""Digests of the canonical forms of long licences, by SPDX name; ``license_scan.digest_of`` makes them from the texts."""

# Of the public texts, whole and (where a second one is listed) without their appendix or exhibit.
DIGESTS = {
    "Apache-2.0": [
        "6f17d663c300c4c82936d5020e6133d541cb12413c5b3626c41474d171397dce",
        "307d582deac5339254ae72ea942f7214cf047a41fa8748a68ce05fcbc6ddd572",
        "b36e1e033658e04113b33ff4c5cbce6fd79fa6d37e9ef73830546b0861d0647b",
    ],
    "GPL-1.0": [
        "070a0b6a836624738c97b1e93eb4dc8d2251806d39688fecfb99dedfba5bb83b",
        "564aae914584416ddc36a493a4e4db146656438933fab9b084da26aeb666df00",
    ],
    "GPL-2.0": [
        "71cc65745bf3976e7c9044602ffc87edf9bf375633ca27b3ddef779c3295107e",
        "f47217ffa52edd49d2fdc2403d77833b8ea3251742ce7fde32c8de9648d93085",
    ],
    "GPL-3.0": [
        "38ed5200dcfa0dc3b0f7cae425e1c50c231eb98aa9ebbef248b16adf0fcf30b3",
        "f121f5f97cb8e03c71456c4593598af6531d0a0c1b7521d60d1adebf2b2fe6af",
    ],
    "LGPL-2.0": [
        "109dd899641d6c959af2cf4ea289589afd8160b5a606c83ba9c35a0c7de1dbcf",
        "d6d3ba37b5c97237c6b156fd79207484f533699203ca3acec9058dcc50f3c87d",
    ],
    "LGPL-2.1": [
        "741c2f1fec0a2a9437656acdc3ead5d2da1794b5ee405938f1c25c0279da7a80",
        "17e1d9fe823d17946a2c30abd6debdbcaf420f079c6a041525567acb83028ffc",
    ],
    "LGPL-3.0": [
        "f610b3990ede3b0fb2e0f48c3ccd315d1f19049e591a56f43272d1f440015706",
    ],
    "GFDL-1.2": [
        "e8b9052fb78587253f91be32f24005bbe9b90ce1a7d4ac33b8825359d01f7ff8",
    ],
    "GFDL-1.3": [
        "9e5e05c0c2db86d728b7d9ce244542cbe4aa48fae89ea5a5c258d7aac73f8fa4",
    ],
    "Artistic-1.0-Perl": [
        "0033b52096cbf64ab6f8436ee43796ba835d3dd4a56b344b5145c2f6be0b58ab",
    ],
    "MPL-1.1": [
        "84961d3b46032952fb398454188cc7dd83ce1c1c5ef8cf76ed2304532cd66e8c",
        "a460e7e5501a2207b543a397275e4873b1035b667767ed4bf73c75ee5f1cf017",
    ],
    "MPL-2.0": [
        "4067dc897ef79e6b48be60ef72a3885a57f6f05f23873793913b336b42096ec6",
        "96f6e3e0055d8f0fb1ce93d41d171705b25c5c9c7269018b338e0f22d392d06b",
    ],
    "CC0-1.0": [
        "888ab175b43ed137ae3c3f8f32a1f0e1677fe31f7a9f09890c39b11b1934ad6c",
    ],
    "BSD-3-Clause-UC": [
        "d0a339eb5454123c6a1f2696aace557e0561866f3fe33b93ffad58ecfcab7060",
    ],
}
